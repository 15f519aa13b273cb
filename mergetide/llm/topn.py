"""Problem 4: the N best items of every group, by secondary sort.

Each partition is sorted by group, score and item, and its Arrow batches are streamed, keeping the first N different items of each group; of
a group only the N items kept so far are held. This runs twice: where the rows are read, as a combiner, and after hashing by group. The
combiner is exact: an item of the N best is also among the N best of the partition that holds its best row. So a group with a third of all
rows sends at most N rows of each partition over the network, and no task gets more of it than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.session import ship
from mergetide.sources import read_table


def _first_n(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept = None, []
        for b in batches:
            if not b.num_rows:
                continue
            runs = pc.run_end_encode(b.column(0))
            items, take, start = b.column(2).to_pylist(), [], 0
            for end, value in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if value != group:
                    group, kept = value, []
                for j in range(start, end):
                    if len(kept) >= n:
                        break
                    if items[j] not in kept:
                        kept.append(items[j])
                        take.append(j)
                start = end
            if take:
                yield b.take(pa.array(take))

    return run


def top_n(rows: DataFrame, group: str, score: str, item: str, n: int) -> DataFrame:
    """(group, score, item): the n items of each group with the highest scores, each with its highest; ties go to the smaller item.

    Rows with a null group or item, or a null or NaN score, don't count. A repeated item counts once. A group with fewer items gives all it
    has; an empty table gives none; other columns are ignored. n < 1 gives no rows. -0.0 and 0.0 tie.
    """
    ship(rows.sparkSession)
    use = rows.select(rows[group].alias("g"), (rows[score].cast("double") + F.lit(0.0)).alias("s"), rows[item].alias("i")).where("g is not null and i is not null and s is not null and not isnan(s)")
    if n < 1:
        use = use.limit(0)
    order, step = [F.col("g"), F.col("s").desc(), F.col("i")], _first_n(n)
    part = use.sortWithinPartitions(*order).mapInArrow(step, use.schema)
    best = part.repartition("g").sortWithinPartitions(*order).mapInArrow(step, use.schema)
    return best.select(F.col("g").alias(group), F.col("s").alias(score), F.col("i").alias(item))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "candidates", "accountId", "identityId", "score")
    return top_n(rows, "accountId", "score", "identityId", 3).select("accountId", "identityId")


P4_SQL = """
select accountId, identityId from (
  select accountId, identityId, row_number() over (partition by accountId order by max(score) desc, identityId) as r
  from candidates where score is not null and not isnan(score) and identityId is not null and accountId is not null group by 1, 2)
where r <= 3
"""

QUERIES = {"p4_found": p4_found}
ORACLES = {"p4_found": P4_SQL}
