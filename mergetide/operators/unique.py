"""Unique values: every row gets the first free one of its candidates, in the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.functions.template import attribute
from mergetide.functions.text import padded, present
from mergetide.operators.ordinals import running_number
from mergetide.session import cut, told


def counted_template(expression: str) -> str:
    """The template with $counter at its end, unless it has a counter, a UUID or a directive."""
    return expression if any(x in expression for x in ("$counter", "${counter}", "$UUID", "${UUID}", "#")) else expression + "$counter"


def allocate_template(rows: DataFrame, key: str, order: str, expression: str, taken: DataFrame | None = None, most: int = 20, digits: int = 1, existing: str | None = None, anew: Column | None = None) -> DataFrame:
    """(key, value) by a template over the rows' columns: $counter is empty at the first attempt, then 1, 2, ... with zeros to ``digits``; $UUID is a random
    id of the row, drawn once and written.

    Rows that have a value already (column ``existing``) keep it, and no other row gets it, unless ``anew`` is true for them. A template that gives nothing
    gives null.
    """
    rows = rows.withColumn("UUID", F.uuid()) if "UUID" in expression else rows
    rows = cut(rows) if "UUID" in expression else rows
    kept = None
    if existing:
        keeps = present(F.col(existing)) & ~F.coalesce(anew if anew is not None else F.lit(False), F.lit(False))
        kept = rows.where(keeps).select(F.col(key), F.col(existing).alias("value"))
        taken = kept.select("value") if taken is None else taken.select("value").unionByName(kept.select("value"))
        rows = rows.where(~F.coalesce(keeps, F.lit(False)))
    names = {c: F.col(c).cast("string") for c, kind in rows.dtypes if kind in ("string", "int", "bigint", "double", "boolean", "timestamp", "date")}
    at = lambda n: attribute(counted_template(expression), names | {"counter": n})
    # Every attempt differs from the first by the counter alone, so the values are made where they are asked for.
    wide = rows.select(F.col(key), F.col(order), F.array(*[at(F.lit("") if k == 0 else F.lit(str(k).rjust(digits, "0"))) for k in range(most + 1)]).alias("values"))
    got = allocate(wide, key, order, "values", taken, most)
    return got if kept is None else got.unionByName(kept)


def allocate(rows: DataFrame, key: str, order: str, base: str, taken: DataFrame | None = None, most: int = 20) -> DataFrame:
    """(key, value): base, base1, base2, ... : the first that no earlier row (by ``order``, unique) and no row of ``taken`` (column value) has. ``base`` may also
    be an array of the values to try.

    Rows beyond ``most`` attempts and rows with a null base get null. As every value goes to the lowest ordinal that asks for it, the result is
    that of going through the rows one by one; it is reached in rounds, all rows at once: each asks for a candidate, the lowest asker holds it until
    a lower one asks, and who loses asks for the next. At most ``most`` + 1 values of a base are ever given, so the rows of a base beyond the
    first ``most`` + 1 only lose.
    """
    todo = rows.select(F.col(key).alias("key"), F.col(order).alias("ord"), F.col(base).alias("base"))
    held = None if taken is None else taken.select(F.col("value")).where("value is not null").distinct()
    listed = dict(todo.dtypes)["base"].startswith("array")
    value = F.get("base", F.col("n")) if listed else F.concat("base", F.when(F.col("n") > 0, F.col("n").cast("string")).otherwise(""))
    asking = todo.where("base is not null" + (" and base[0] is not null" if listed else ""))
    state = cut(asking.withColumn("n", F.lit(0)))
    while True:
        asked = state.where(F.col("n") <= most).withColumn("value", value)
        if held is not None:
            asked = asked.join(held.withColumn("held", F.lit(True)), "value", "left")
        else:
            asked = asked.withColumn("held", F.lit(None).cast("boolean"))
        winner = asked.groupBy("value").agg(F.min("ord").alias("win"))
        judged = asked.join(winner, "value").withColumn("lost", F.coalesce("held", F.lit(False)) | (F.col("ord") != F.col("win")))
        moved = judged.select("key", "ord", "base", (F.col("n") + F.col("lost").cast("int")).alias("n"), "lost")
        late = state.where(F.col("n") > most).select("key", "ord", "base", "n", F.lit(False).alias("lost"))
        state = cut(moved.unionByName(late), state, lost=F.count_if(F.col("lost")))
        if not told(state, "lost"):
            break
    done = state.where(F.col("n") <= most).select("key", value.alias("value"))
    return todo.select("key").join(done, "key", "left").select(F.col("key").alias(key), "value")


def numbered(rows: DataFrame, key: str, order: Column, base: Column, start: int = 1, digits: int = 0) -> DataFrame:
    """(key, value): base and a running number over all rows of that base, from ``start``, with zeros to ``digits``."""
    df = running_number(rows.select(F.col(key), order.alias("ord"), base.alias("base")), ["base"], ["ord"], "n").withColumn("n", F.col("n") + (start - 1))
    return df.select(key, F.concat("base", padded(F.col("n"), digits) if digits else F.col("n").cast("string")).alias("value"))


def counter_seed(values: Column) -> Column:
    """An aggregate: the greatest number at the end of the values, 0 if there is none."""
    return F.coalesce(F.max(F.regexp_extract(values, r"(\d{1,18})\s*$", 1).try_cast("long")), F.lit(0))
