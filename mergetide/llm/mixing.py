"""Problem 9: a mix of sources at target shares of the total size, by fitting document lengths into each source's budget."""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergetide.llm.tokenize import TOKENIZER, token_count
from mergetide.session import cut
from mergetide.sources import read_table

#: The part of a budget that is fitted exactly by dynamic programming, in tokens, and the parts into which a length is split for picking.
EXACT_TOKENS, BUCKETS = 1 << 15, 1024


def source_name(c: Column) -> Column:
    """Lower case, without white space around it."""
    return F.lower(F.regexp_replace(c, r"^[\s ​﻿]+|[\s ​﻿]+$", ""))


def fit(lengths: list[int], counts: list[int], budget: int, exact: int = EXACT_TOKENS) -> list[int]:
    """How many items of each length to take so that their sum comes as near to the budget as it can from below.

    Every length first gives its proportional part, rounded down; items of the longest lengths that still fit bring what is left under ``exact``
    tokens; a bounded knapsack fits that rest. Lengths are positive and different.
    """
    total = sum(x * c for x, c in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    left = budget - sum(x * t for x, t in zip(lengths, take, strict=True))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        if left <= exact:
            break
        more = min(counts[i] - take[i], (left - exact + lengths[i] - 1) // lengths[i], left // lengths[i])
        take[i] += more
        left -= more * lengths[i]
    # reach: bit s is set if s tokens can be filled; counts are split into powers of two.
    room, reach, steps = (1 << min(left, exact) + 1) - 1, 1, []
    limit = min(left, exact)
    for i in order:
        if lengths[i] > limit:
            continue
        free, k = min(counts[i] - take[i], limit // lengths[i]), 1
        while free > 0 and not reach >> limit & 1:
            k = min(k, free)
            steps.append((i, k, reach))
            reach |= reach << k * lengths[i] & room
            free, k = free - k, k * 2
        if reach >> limit & 1:
            break
    s = reach.bit_length() - 1
    for i, k, earlier in reversed(steps):
        if not earlier >> s & 1:
            take[i] += k
            s -= k * lengths[i]
    return take


def mix(documents: DataFrame, targets: DataFrame, key: str, source: str, size: str, total: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(chosen, report). chosen: key, source, tokens, times (how often the document is repeated, 1 or more). report: a row for each target.

    ``documents`` has ``size`` in tokens. ``targets``: source, target_share, max_repeats; its rows are few and are read to the driver, as are the
    sources' totals. ``total``: the tokens of the mix; by default the most at which every source that has documents reaches its share. Shares
    of sources without documents, or with no repeats, are spread over the others in proportion. A source whose budget exceeds what it may give, as can
    happen with a given ``total``, gives all of it; the report shows the share it reaches.

    A source is taken whole as often as its budget holds; for the rest, documents are counted by exact length, numbers are fitted to the rest of
    the budget by ``fit``, and of each length the documents with the smallest seeded hashes are taken. Documents of no tokens, null sources and
    sources without a target are not chosen. Ties of the hash (repeated rows) are broken by key. Empty tables give an empty mix.
    A length that a third of all documents have is split into BUCKETS parts, of which one at most has to be sorted.
    """
    spark = documents.sparkSession
    names = [(r["source"], r["target_share"], r["max_repeats"]) for r in targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats")).where("source is not null").dropDuplicates(["source"]).collect()]
    share = {s: (w or 0.0, r or 0) for s, w, r in names}
    docs = documents.select(documents[key].alias("key"), source_name(documents[source]).alias("source"), documents[size].cast("long").alias("tokens"), F.pmod(F.xxhash64(documents[key], F.lit(seed)), F.lit(2**62)).alias("h"))
    docs = cut(docs.where(F.col("source").isin(list(share)) & (F.col("tokens") > 0)).withColumn("b", F.col("h") % BUCKETS))
    parts = docs.groupBy("source", "tokens", "b").agg(F.count("*").alias("n"))
    lengths = parts.groupBy("source", "tokens").agg(F.sum("n").alias("n"))
    have = {r["source"]: r["t"] for r in lengths.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).alias("t")).collect()}
    usable = {s: t for s, t in have.items() if share[s][0] > 0 and share[s][1] > 0}
    # Exact fractions: rounded down twice, the source that limits the mix would lose a whole copy.
    exact = {s: Fraction(share[s][0]).limit_denominator(10**9) for s in usable}
    weight = sum(exact.values(), Fraction(0)) or Fraction(1)
    whole = min((t * share[s][1] * weight / exact[s] for s, t in usable.items()), default=Fraction(0)) if total is None else Fraction(total)
    budget = {s: min(int(whole * exact[s] / weight), t * share[s][1]) for s, t in usable.items()}
    plan = {s: (b // have[s], b % have[s]) for s, b in budget.items()}

    def per_source(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, rest = plan.get(pdf["source"].iloc[0], (0, 0))
        pdf = pdf.sort_values("tokens")
        extra = fit(pdf["tokens"].tolist(), pdf["n"].tolist(), rest)
        return pd.DataFrame({"source": pdf["source"], "tokens": pdf["tokens"], "whole": whole, "extra": extra})

    picked = lengths.groupBy("source").applyInPandas(per_source, "source string, tokens long, whole long, extra long")
    # Within a length, part by part in the order of b: whole parts, then a piece of one part.
    cum = parts.join(picked, ["source", "tokens"])
    starts = cum.groupBy("source", "tokens").agg(F.first("whole").alias("whole"), F.first("extra").alias("extra"), F.array_sort(F.collect_list(F.struct("b", "n"))).alias("bs"))
    starts = starts.select("source", "tokens", "whole", F.expr("aggregate(bs, named_struct('left', extra, 'm', cast(array() as array<struct<b:bigint,n:bigint>>)), (a, x) -> named_struct('left', a.left - least(a.left, x.n), 'm', array_append(a.m, named_struct('b', x.b, 'n', least(a.left, x.n))))).m").alias("m"))
    quota = starts.select("source", "tokens", "whole", F.explode("m").alias("x")).select("source", "tokens", "whole", F.col("x.b").alias("b"), F.col("x.n").alias("quota"))
    quota = quota.join(parts, ["source", "tokens", "b"])
    marked = docs.join(quota, ["source", "tokens", "b"])
    sure = marked.where("quota = 0 or quota = n").withColumn("more", (F.col("quota") > 0).cast("long"))
    part = marked.where("quota > 0 and quota < n").withColumn("more", (F.row_number().over(Window.partitionBy("source", "tokens", "b").orderBy("h", "key")) <= F.col("quota")).cast("long"))
    chosen = sure.unionByName(part).select(F.col("key").alias(key), "source", "tokens", (F.col("whole") + F.col("more")).cast("int").alias("times")).where("times > 0")
    given = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("mixed_tokens"), F.count("*").alias("documents"), F.max("times").alias("most_times"))
    rows = spark.createDataFrame([(s, w, r, have.get(s, 0)) for s, (w, r) in share.items()], "source string, target_share double, max_repeats int, available_tokens long")
    report = rows.join(given, "source", "left").na.fill(0, ["mixed_tokens", "documents", "most_times"])
    # One row for each target, so one task may sum them; and nothing is computed until the report is read.
    sums = F.sum("mixed_tokens").over(Window.partitionBy())
    report = report.withColumn("actual_share", F.when(sums > 0, F.col("mixed_tokens") / sums).otherwise(F.lit(0.0)))
    return chosen, report


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "source", "text")
    return docs.select("doc_id", "source", token_count(F.col("text"), TOKENIZER).alias("tokens"))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix: each chosen document and how often it is repeated."""
    return mix(_sized(spark, folder), read_table(spark, folder, "mix_targets"), "doc_id", "source", "tokens")[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares reached beside those wanted."""
    return mix(_sized(spark, folder), read_table(spark, folder, "mix_targets"), "doc_id", "source", "tokens")[1]


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
ORACLES: dict[str, str] = {}
