"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergetide.session import cut, told


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the nodes of the edges with the smallest node of their component.

    Null ends are left out; loops and repeated edges do no harm; an empty table gives no rows. Rounds of two star steps: every node hands its
    smallest neighbour to its larger ones, then all its neighbours to its smallest one; what is left is one star per component. The rounds grow with
    the logarithm of the longest chain. Each step is one shuffle, with the smallest neighbour found by a partial aggregation, so that
    a node with many neighbours holds up no task.
    """
    given = cut(edges.where(f"`{a}` is not null and `{b}` is not null").select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    ends = given.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    e = given.where("u < v")
    before = None
    while True:
        # Large star: larger neighbours of a node are joined to the smallest node of its neighbourhood.
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.u", "x.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        # Small star: a node and its smaller neighbours are joined to the smallest of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u <> v").distinct()
        e = cut(small, *([e] if before else []), sum=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        now = told(e), told(e, "sum")
        if now == before:
            break
        before = now
    return ends.join(e.select(F.col("v").alias("node"), F.col("u").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
