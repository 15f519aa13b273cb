"""Reports: the state of every account, sections, categories and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.operators.ordinals import running_number


def account_status(matched: Column, deferred: Column, failed: Column, analyzed: Column) -> Column:
    """The first that holds: deferred, review-error, matched, non-matched; not-analyzed if none was asked."""
    return F.when(deferred, "deferred").when(failed, "review-error").when(matched, "matched").when(analyzed, "non-matched").otherwise("not-analyzed")


def first_category(categories: dict[str, Column], chosen: list[str] | None = None) -> Column:
    """The first of the named conditions that holds, in their order; null if none does."""
    out = None
    for name, c in categories.items():
        if chosen is None or name in chosen:
            out = F.when(c, name) if out is None else out.when(c, name)
    return out if out is not None else F.lit(None).cast("string")


def all_categories(categories: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(c, name) for name, c in categories.items()]), lambda x: x.isNotNull())


def summary(rows: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One row of conditional counts."""
    return rows.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def sectioned(rows: DataFrame, section: Column, name: str) -> DataFrame:
    """rows with ``section`` and ``place``: the rank by name within it."""
    df = running_number(rows.withColumn("section", section).withColumn("_lower", F.lower(name)), ["section"], ["_lower", name], "place")
    return df.drop("_lower")


def nested(rows: DataFrame, by: str, fields: list[str], order: list[str], at: str) -> DataFrame:
    """One row per ``by`` with the sorted array ``at`` of structs of the fields."""
    return rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))).alias(at))


# The categories of report rows, in the order in which rows are emitted.
CATEGORIES = ["baseline", "identity-linked", "nonMatched", "matched", "exact", "deferred", "review", "decisions", "existing-fusion"]


def row_categories(statuses: Column, identity: Column, status: Column, exact: Column, pending: Column, decided: Column, listed: Column) -> Column:
    """array: the CATEGORIES of a report row. statuses: array of its statuses; identity: the identity it is tied to; status: see account_status; exact: a match
    of it is exact; pending: a review of it is open; decided: one of its accounts has a decision; listed: it is a row of the engine's own output."""
    has = lambda x: F.coalesce(F.array_contains(statuses, x), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    matched = yes(status == "matched")
    holds = [has("baseline"), ~has("baseline") & yes(F.trim(identity) != ""), has("nonMatched") | yes(status == "non-matched"), matched, matched & yes(exact), yes(status == "deferred"), yes(pending), yes(decided), yes(listed)]
    return all_categories(dict(zip(CATEGORIES, holds, strict=True)))


def emitted(rows: DataFrame, key: str, categories: str, selected: list[str] | None = None) -> DataFrame:
    """rows with ``group`` and ``place``: those with a selected category, each key once, under the first of its categories that is selected, in the order of
    CATEGORIES and then of the key."""
    chosen = [c for c in CATEGORIES if selected is None or c in selected]
    mine = F.array_intersect(F.array(*[F.lit(c) for c in chosen]), F.col(categories)) if chosen else F.array().cast("array<string>")
    df = rows.withColumn("group", F.get(mine, F.lit(0))).where("group is not null")
    rank = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("group"))
    names = [c for c in df.columns if c != key]
    best = F.min(F.struct(rank.alias("_rank"), *names)).alias("b")
    df = df.groupBy(key).agg(best).select(key, *[F.col(f"b.{c}").alias(c) for c in names], F.col("b._rank").alias("_rank"))
    return running_number(df, [], ["_rank", key], "place").drop("_rank")


def option_counts(rows: DataFrame, categories: str, status: str) -> DataFrame:
    """One row: how many emitted rows each option of a report stands for, and how many failed."""
    has = {f"n_{c.replace('-', '_')}": F.array_contains(categories, c) for c in CATEGORIES[2:8]}
    return summary(rows, has | {"n_review_error": F.col(status) == "review-error"})


def covered(rows: DataFrame, accounts: str) -> DataFrame:
    """(account): the accounts that output rows hold, each once."""
    return rows.select(F.explode(accounts).alias("account")).where("account is not null").distinct()


def deferred_stubs(report: DataFrame, rows: DataFrame, accounts: str) -> DataFrame:
    """Rows for deferred accounts with matches (``report``: account, deferred, matches) that no output row holds: key, accounts, statuses."""
    left = report.where("deferred and matches > 0 and account is not null").select("account").distinct().join(covered(rows, accounts), "account", "left_anti")
    return left.select(F.concat(F.lit("orphan-deferred:"), "account").alias("key"), F.array("account").alias("accounts"), F.array().cast("array<string>").alias("statuses"))


def decision_counts(made: DataFrame) -> DataFrame:
    """One row: the finished decisions (see operators.reviews) by source type, those that are new or without a match, and those made without a reviewer."""
    t = lambda k: F.col("source_type") == k
    counts = {k: t(k) for k in ("authoritative", "record", "orphan")}
    return summary(made.where("finished"), counts | {"new_identities": t("authoritative") & F.col("is_new"), "no_matches": ~t("authoritative") & F.col("is_new"), "automatic": F.col("reviewer") == "system"})
