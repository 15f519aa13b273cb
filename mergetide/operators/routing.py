"""Where each account goes after matching, and what that asks other systems to do, as tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.operators.claims import conflicts


@dataclass(frozen=True)
class Toggles:
    """assign_exact: exact matches are assigned without a review. score_records: accounts of record sources are matched. defer: those of authoritative
    sources wait for earlier ones like them."""

    assign_exact: bool = False
    score_records: bool = True
    defer: bool = True


def unmatched(source_type: Column, disables: Column) -> Column:
    """What becomes of an account without a match: emit (authoritative, or unknown), register (record), disable or drop (orphan)."""
    return F.when(source_type == "record", "register").when((source_type == "orphan") & F.coalesce(disables, F.lit(False)), "disable").when(source_type == "orphan", "drop").otherwise("emit")


def routed(accounts: DataFrame, toggles: Toggles | None = None) -> DataFrame:
    """accounts with ``outcome``: linked, assign, review, defer, emit, register, disable or drop; the first that holds.

    Columns: linked (the account or its identity already has a row), correlated, reviewers (how many its source has), source_type, disables (the source's
    option), exact and matched (identities that match it so; counts), peers (earlier unmatched accounts of its source that match it). Null counts
    as none. Correlated accounts, and those of sources without reviewers, are not matched at all; nor are those of record sources, if they are not to be.
    """
    t = toggles or Toggles()
    some = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    plain = unmatched(F.col("source_type"), F.col("disables"))
    asked = ~yes("correlated") & some("reviewers") & (F.lit(t.score_records) | (F.coalesce("source_type", F.lit("")) != "record"))
    out = F.when(yes("linked"), "linked").when(~asked, plain)
    out = out.when(some("exact") & F.lit(t.assign_exact), "assign").when(some("exact") | some("matched"), "review")
    waits = some("peers") & F.lit(t.defer) & (F.coalesce("source_type", F.lit("authoritative")) == "authoritative")
    return accounts.withColumn("outcome", out.when(waits, "defer").otherwise(plain))


def automatic(assigned: DataFrame, account: str, identity: str) -> DataFrame:
    """Assignments of exact matches as decisions, in the columns of reviews.decisions."""
    text = lambda x: F.lit(x)
    return assigned.select(F.concat(F.lit("auto:"), account).alias("instance"), F.lit(0).cast("long").alias("ord"), text("system").alias("reviewer"), F.col(account).alias("account"), F.col(account).alias("account_name"), text("").alias("source_name"), text("authoritative").alias("source_type"), F.lit(False).alias("is_new"), F.col(identity).alias("identity_id"), text("exact match").alias("comments"), F.lit(True).alias("finished"), F.lit(None).cast("string").alias("url"))


def applied(made: DataFrame, rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(instance, account, identity_id, effect, row_id): what each finished decision does.

    One that assigns merges into the row that its identity has (``rows``: row_id, identity_id; the first row_id if there are several), or makes one ("create").
    A new one goes by its source's type, as an unmatched account does (``sources``: name, disables).
    """
    have = rows.where("identity_id is not null").groupBy("identity_id").agg(F.min("row_id").alias("row_id"))
    options = F.broadcast(sources.select(F.col("name").alias("source_name"), "disables").dropDuplicates(["source_name"]))
    df = made.where("finished").join(options, "source_name", "left").join(have, "identity_id", "left")
    effect = F.when(F.col("is_new"), unmatched(F.col("source_type"), F.col("disables"))).when(F.col("row_id").isNotNull(), "merge").otherwise("create")
    return df.select("instance", "account", "identity_id", effect.alias("effect"), F.when(~F.col("is_new"), F.col("row_id")).alias("row_id"))


def correlations(assigned: DataFrame, managed: DataFrame) -> DataFrame:
    """(key, identity_id): the accounts whose identity another system is to set: those assigned (key, identity_id) that aren't correlated so already
    (``managed``: key, identity_id)."""
    known = managed.select("key", F.col("identity_id").alias("_now"))
    return assigned.select("key", "identity_id").distinct().join(known, "key").where(~F.col("identity_id").eqNullSafe(F.col("_now"))).select("key", "identity_id")


def disables(outcomes: DataFrame, key: str) -> DataFrame:
    """(key): the accounts to disable, each once, that aren't yet."""
    return outcomes.where((F.col("outcome") == "disable") & ~F.coalesce("disabled", F.lit(False))).select(key).distinct()


def without_orphans(rows: DataFrame) -> DataFrame:
    """The rows to emit where orphans are to go: those with accounts, or with the status "baseline"."""
    return rows.where((F.size(F.coalesce("accounts", F.array().cast("array<string>"))) > 0) | F.coalesce(F.array_contains("statuses", "baseline"), F.lit(False)))


def conflicting(made: DataFrame) -> DataFrame:
    """(account, identity_id, n): the accounts that finished decisions give to several identities, with each of these and their number."""
    return conflicts(made.where("finished and not is_new"), "identity_id", ["account"])
