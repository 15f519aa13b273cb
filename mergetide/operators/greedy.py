"""Ordered greedy algorithms in parallel rounds: leader clustering and exclusive assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergetide.session import cut, told


def leaders(nodes: DataFrame, edges: DataFrame, node: str, a: str, b: str, order: str) -> DataFrame:
    """(node, leader): going through the nodes by ``order`` (unique), a node that matches an earlier leader joins the earliest such, else it leads.

    That is the lexicographically first maximal independent set, found in rounds: a node whose earlier neighbours all follow leads; one with an earlier leader
    follows. ``edges`` join nodes by ``a`` and ``b`` in any direction; loops, repeated edges and ends that are no nodes don't matter.
    """
    n = nodes.select(F.col(node).alias("v"), F.col(order).alias("o"))
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    e = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y").distinct()
    e = e.join(n.select(F.col("v").alias("x"), F.col("o").alias("ox")), "x").join(n.select(F.col("v").alias("y"), F.col("o").alias("oy")), "y").where("oy < ox")
    e = cut(e.select(F.col("x").alias("v"), F.col("y").alias("u")))  # u is earlier
    done = cut(n.join(e.select("v").distinct(), "v", "left_anti").select("v", F.lit(True).alias("leads")))
    while True:
        open_ = e.join(done.select("v"), "v", "left_anti")
        seen = open_.join(done.select(F.col("v").alias("u"), "leads"), "u", "left").groupBy("v").agg(F.coalesce(F.max("leads"), F.lit(False)).alias("led"), F.count("*").alias("n"), F.count("leads").alias("k"))
        new = cut(seen.where("led or n = k").select("v", (~F.col("led")).alias("leads")))
        if not told(new):
            break
        done = cut(done.unionByName(new), done, new)
    own = e.join(done.where("leads").select(F.col("v").alias("u")), "u").join(n.select(F.col("v").alias("u"), F.col("o").alias("ou")), "u")
    first = own.groupBy("v").agg(F.min_by("u", "ou").alias("u"))
    out = done.join(first, "v", "left").select("v", F.when(F.col("leads"), F.col("v")).otherwise(F.col("u")).alias("leader"))
    return out.select(F.col("v").alias(node), "leader")


def exclusive(matches: DataFrame, account: str, identity: str, account_order: str, order: str) -> DataFrame:
    """(account, identity): going through the accounts by ``account_order``, each gets its first identity by ``order`` that no earlier one got.

    Rounds of proposals: every account asks for its first identity that no earlier account holds; the earliest asker holds it, others ask
    on. As identities prefer earlier accounts, this ends where going one by one does; and as a hold only ever goes to an earlier account, all that an
    account has lost to earlier ones is left out at once. Ties of ``order`` go to the smaller identity.
    """
    m = cut(matches.select(F.col(account).alias("a"), F.col(identity).alias("i"), F.col(account_order).alias("ao"), F.col(order).alias("o")).distinct())
    held = None
    while True:
        free = m if held is None else m.join(held, "i", "left").where(F.coalesce(F.col("by") >= F.col("ao"), F.lit(True)))
        asks = free.groupBy("a", "ao").agg(F.min(F.struct("o", "i")).alias("t")).select("a", "ao", "t.i")
        wins = asks.groupBy("i").agg(F.min(F.struct("ao", "a")).alias("w")).select("i", F.col("w.ao").alias("by"), F.col("w.a").alias("winner"))
        asks = cut(asks.join(wins, "i"), beaten=F.count_if(F.expr("a <> winner")))
        if not told(asks, "beaten"):
            return asks.select(F.col("a").alias(account), F.col("i").alias(identity))
        held = asks.where("a = winner").select("i", "by")
