"""Scans of accounts and identities: predicates, keys, ordinals and limits."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mergetide.functions.keys import account_key
from mergetide.operators.ordinals import running_number


class FilterError(ValueError):
    pass


_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")
_NOT_OF_A_ROW = re.compile(r"\bselect\b|\bover\s*\(", re.IGNORECASE)


def checked_filter(df: DataFrame, predicate: str | None) -> DataFrame:
    """df where a SQL predicate over its columns holds; what isn't one fails here, before any row is read. None and blank keep all rows.

    A predicate is about one row, so subqueries and windows are refused, outside of quoted texts and names; aggregates fail in the analysis.
    """
    if not predicate or not predicate.strip():
        return df
    if _NOT_OF_A_ROW.search(_QUOTED.sub("''", predicate)):
        raise FilterError("a filter is about one row")
    return df.where(predicate)


def scan_accounts(managed: DataFrame, sources: DataFrame, filters: dict[str, str] | None = None, machines: bool = False) -> DataFrame:
    """Accounts of the enabled sources: with key, source order and account order, machines left out unless asked for, rows without a key dropped.

    ``filters``: a predicate by source id. Of rows with one key the last by id stays. ``src_ord`` follows the priority, ``acct_ord`` the id in the source.
    """
    src = sources.where("coalesce(enabled, true)").select(F.col("id").alias("source_id"), F.col("priority").alias("src_ord"), "source_type")
    df = managed if machines else managed.where("not coalesce(is_machine, false)")
    for s, p in (filters or {}).items():
        kept = checked_filter(df.where(F.col("source_id") == s), p)
        df = df.where(F.col("source_id") != s).unionByName(kept)
    df = df.withColumn("key", account_key(F.col("source_id"), F.col("native_identity"))).where("key is not null").join(src, "source_id")
    last = F.row_number().over(Window.partitionBy("key").orderBy(F.col("id").desc()))
    df = df.withColumn("_n", last).where("_n = 1").drop("_n")
    return running_number(df, ["source_id"], ["id"], "acct_ord")


def limited(accounts: DataFrame, limits: dict[str, int], done: dict[str, int] | None = None) -> DataFrame:
    """The accounts that a run takes: of each source with a limit, those up to the number taken before plus the limit, in their order. The limit is the feature."""
    m = {s: n + (done or {}).get(s, 0) for s, n in limits.items()}
    if not m:
        return accounts
    most = F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("source_id"))
    return accounts.where(F.coalesce(F.col("acct_ord") <= most, F.lit(True)))


def scan_identities(identities: DataFrame, predicate: str | None = None, protected: bool = False) -> DataFrame:
    """Identities in scope, protected ones left out unless asked for."""
    return checked_filter(identities if protected else identities.where("not coalesce(protected, false)"), predicate)


def checked_sources(config: DataFrame, sources: DataFrame) -> DataFrame:
    """The configured sources (column name, and any options) with what is known of them (id, name, ...), by exact name; fails if one is unknown."""
    known = sources.select(*[F.col(c) for c in sources.columns if c == "name" or c not in config.columns])
    lost = config.join(known.select("name"), "name", "left_anti").select("name").orderBy("name").head(5)
    if lost:
        raise FilterError("no such source: " + ", ".join(str(r["name"]) for r in lost))
    return config.join(F.broadcast(known), "name")


def by_key(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """Point lookup: the rows whose key is one of the values; the predicate reaches the scan."""
    return rows.where(F.col(key).isin(list(values)))


def hydrated(rows: DataFrame, key: str, identities: DataFrame, keep: list[str]) -> DataFrame:
    """rows with the fields ``keep`` of the identity that ``key`` names; null where there is none (best effort)."""
    return rows.join(identities.select(F.col("id").alias(key), *keep).dropDuplicates([key]), key, "left")


def due(sources: DataFrame, runs: DataFrame, source: str, run: str, at: str) -> DataFrame:
    """(source, latest, due): whether a source is to be read again: its run ended later than the engine's own latest run, or either never ran.

    ``sources``: source and at (the sources' own runs, any number); ``runs``: run and at of the engine by source.
    """
    own = sources.groupBy(source).agg(F.max(at).alias("latest"))
    mine = runs.groupBy(F.col(run).alias(source)).agg(F.max(at).alias("done"))
    return own.join(mine, source, "left").select(source, "latest", F.coalesce(F.col("done") <= F.col("latest"), F.lit(True)).alias("due"))


def latest_by_source(rows: DataFrame, source: str, at: str) -> DataFrame:
    return rows.groupBy(source).agg(F.max(at).alias("latest"))
