"""Claims: every account belongs to the first phase that takes it; joins by identity and by key; overlaps and conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def claimed(claims: DataFrame, key: str, phase: str, owner: str, order: str) -> DataFrame:
    """One row per key: the claim of the lowest phase, then the lowest order. One aggregation in place of a chain of anti-joins."""
    best = F.min(F.struct(F.col(phase), F.col(order), F.col(owner))).alias("b")
    return claims.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, f"b.{phase}", f"b.{owner}")


def unclaimed(accounts: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    return accounts.join(claims.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def identity_keys(identities: DataFrame, sources: DataFrame) -> DataFrame:
    """(identity_id, source_id, native_identity) of the accounts that identities list, of the given sources only, each once."""
    one = identities.select(F.col("id").alias("identity_id"), F.explode("accounts").alias("a")).select("identity_id", F.trim("a.source.id").alias("source_id"), F.trim("a.native_identity").alias("native_identity"))
    ok = one.where("length(source_id) > 0 and length(native_identity) > 0").distinct()
    return ok.join(sources.select(F.col("id").alias("source_id")).distinct(), "source_id", "left_semi")


def overlap_owner(listed: DataFrame, rows: DataFrame, listed_owner: str, row: str, keys: list[str], rank: list[str]) -> DataFrame:
    """(listed_owner, row): of the rows that share a key with a listed owner, the first by ``rank`` (columns of ``rows``)."""
    met = listed.join(rows, keys)
    return met.groupBy(listed_owner).agg(F.min(F.struct(*[F.col(r) for r in rank], F.col(row))).alias("b")).select(listed_owner, F.col(f"b.{row}").alias(row))


def conflicts(listed: DataFrame, owner: str, keys: list[str]) -> DataFrame:
    """(keys, owner, n): the keys that several owners list, a row for each owner, with their number. Rows, as one key may have any number of owners."""
    pairs = listed.select(*keys, owner).where(F.col(owner).isNotNull()).distinct()
    many = pairs.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return pairs.join(many, keys).select(*keys, owner, "n")


def missing_by_source(rows: DataFrame, present: DataFrame, owner: str, source: str, native: str) -> DataFrame:
    """(owner, source, first_missing, missing): for each owner and source, the listed keys that have no account, the least and their number."""
    gone = rows.join(present.select(source, native).distinct(), [source, native], "left_anti")
    return gone.groupBy(owner, source).agg(F.min(native).alias("first_missing"), F.countDistinct(native).alias("missing"))


def last_by_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
