"""Problem 7: the surviving value of every field of a group of duplicates, in one aggregation of composite structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.sources import read_table

# Texts that people and exports put where a value is missing, in lower case.
FILLERS = ["-", "--", ".", "?", "n/a", "na", "nil", "no email", "none", "none@none", "not available", "not provided", "null", "pending", "see badge", "see hr", "tba", "tbc", "tbd", "test", "unknown", "x", "xx", "xxx"]
EMAIL = r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+$"


def bare(c: Column) -> Column:
    """The value without white space, byte order marks or zero-width signs around it."""
    return F.regexp_replace(c, r"^[\s ​﻿]+|[\s ​﻿]+$", "")


def real_text(c: Column) -> Column:
    """Has a letter and is no filler."""
    return F.coalesce(bare(c).rlike(r"\p{L}") & ~F.lower(bare(c)).isin(FILLERS), F.lit(False))


def real_email(c: Column) -> Column:
    """A mailbox and a domain with a dot, whatever case, "mailto:" or ";" it carries; a misspelt domain is real."""
    t = F.lower(F.regexp_replace(F.regexp_replace(bare(c), r"(?i)^mailto:\s*", ""), r"[\s;,]+$", ""))
    return F.coalesce(t.rlike(EMAIL) & ~F.split_part(t, F.lit("@"), F.lit(1)).isin(FILLERS), F.lit(False))


def real_phone(c: Column) -> Column:
    """Ten digits or more, after a country prefix, that are neither all alike nor a plain count."""
    d = F.regexp_replace(F.regexp_replace(c, r"\D", ""), r"^(?:00)?1(?=\d{10}$)", "")
    return F.coalesce((F.length(d) >= 10) & ~d.rlike(r"^(\d)\1+$") & ~d.isin("1234567890", "0123456789", "9876543210"), F.lit(False))


REAL = {"email": real_email, "phone": real_phone, "title": real_text, "department": real_text}


def survivors(rows: DataFrame, group: str, key: str, modified: str, priority: str, fields: dict[str, Column]) -> DataFrame:
    """(group, field_name, key): for each group of two rows or more and each field, the row whose value survives.

    ``fields`` gives, by name, whether a row's value is real. Among rows with a real value the latest ``modified`` wins (null = oldest),
    then the lowest ``priority`` (null = last), then the smallest ``key``. No row where no value is real. Rows with a null group are left out;
    repeated rows tie and give one; empty tables give none. One aggregation with partial results, whatever the size of a group.
    """
    rank = F.struct(
        F.coalesce(-F.unix_micros(F.col(modified).cast("timestamp")), F.lit(2**63 - 1)).alias("m"),
        F.coalesce(F.col(priority).cast("long"), F.lit(2**63 - 1)).alias("p"),
        F.col(key).alias("k"),
    )
    best = [F.min(F.when(real, rank)).alias(f"f{i}") for i, real in enumerate(fields.values())]
    wide = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), *best).where("n >= 2")
    long = wide.select(group, F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"f{i}.k").alias(key)) for i, f in enumerate(fields)])).alias("x"))
    return long.select(group, "x.field_name", f"x.{key}").where(F.col(key).isNotNull())


def correlated(feed: DataFrame, managed: DataFrame) -> DataFrame:
    """Feed rows with the identity_id of the account that has the same source_id and native identity; null where there is none."""
    of = managed.where("identity_id is not null").groupBy("source_id", F.col("native_identity").alias("id")).agg(F.min("identity_id").alias("identity_id"))
    return feed.join(of, ["source_id", "id"], "left")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    feed = read_table(spark, folder, "identity_feed", "record_id", "source_id", "id", "modified", *REAL)
    managed = read_table(spark, folder, "managed_accounts", "source_id", "native_identity", "identity_id")
    sources = read_table(spark, folder, "sources", "id", "priority").groupBy(F.col("id").alias("source_id")).agg(F.min("priority").alias("priority"))
    # Whether values are real is found before the join, so that no text is shuffled.
    slim = feed.select("record_id", "source_id", "id", "modified", *[f(F.col(c)).alias(c) for c, f in REAL.items()])
    rows = correlated(slim, managed).where("identity_id is not null").join(sources, "source_id", "left")
    return survivors(rows, "identity_id", "record_id", "modified", "priority", {c: F.col(c) for c in REAL})


P7_SQL = r"""
with fillers as (select ['-', '--', '.', '?', 'n/a', 'na', 'nil', 'no email', 'none', 'none@none', 'not available', 'not provided', 'null', 'pending', 'see badge', 'see hr', 'tba', 'tbc', 'tbd', 'test', 'unknown', 'x', 'xx', 'xxx'] as f),
rows as (
  select m.identity_id, r.record_id, r.modified, s.priority, r.title, r.department, regexp_replace(regexp_replace(r.phone, '[^0-9]', '', 'g'), '^(00)?1([0-9]{10})$', '\2') as phone,
    lower(regexp_replace(regexp_replace(trim(r.email, E' \t\n\r ​﻿'), '^mailto:\s*', '', 'i'), '[\s;,]+$', '')) as email,
    count(*) over (partition by m.identity_id) as n
  from identity_feed r join managed_accounts m on r.source_id = m.source_id and r.id = m.native_identity left join sources s on s.id = r.source_id
  where m.identity_id is not null),
vals as (
  select identity_id, record_id, modified, priority, 'email' as field_name from rows, fillers where n > 1 and regexp_matches(email, '^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+$') and not list_contains(f, split_part(email, '@', 1))
  union all
  select identity_id, record_id, modified, priority, 'phone' from rows where n > 1 and length(phone) >= 10 and replace(phone, phone[1], '') <> '' and phone not in ('1234567890', '0123456789', '9876543210')
  union all
  select identity_id, record_id, modified, priority, 'title' from rows, fillers where n > 1 and regexp_matches(title, '\p{L}') and not list_contains(f, lower(trim(title, E' \t\n\r ​﻿')))
  union all
  select identity_id, record_id, modified, priority, 'department' from rows, fillers where n > 1 and regexp_matches(department, '\p{L}') and not list_contains(f, lower(trim(department, E' \t\n\r ​﻿'))))
select identity_id, field_name, record_id from vals
qualify row_number() over (partition by identity_id, field_name order by modified desc nulls last, priority nulls last, record_id) = 1
"""

QUERIES = {"p7_found": p7_found}
ORACLES = {"p7_found": P7_SQL}
