"""Parent-child rows to whole hierarchies, by heavy-path decomposition after the cycles are set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.operators.ordinals import running_sum
from mergetide.session import cut, told


def whole_number(c: Column) -> Column:
    """The number an id spells ("01072", " 1062", "1159.0" and "1062" are two numbers), as text; other texts stay themselves, trimmed.

    Null and blank give null.
    """
    t = F.regexp_replace(c, r"^[\s ​﻿]+|[\s ​﻿]+$", "")
    digits = F.regexp_extract(t, r"^\+?0*([0-9]+)(?:\.0*)?$", 1)
    return F.when(F.length(t) == 0, None).when(digits != "", digits).otherwise(t)


def latest_delivery(df: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order``, nulls least. A partial aggregation, so a hot key is reduced where it is read."""
    # A null field of a struct compares as least.
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in keep if c not in order])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in keep])


def hierarchy(nodes: DataFrame, scope: str, node: str, parent: str, label: str, intervals: bool = False) -> DataFrame:
    """Every node's root, depth, path and number of descendants; with ``intervals`` also which those are.

    ``nodes`` has one row per ``scope`` + ``node``; ``parent`` is a node of the same scope, or null or unknown, which makes the row a root;
    ``label`` is the text that paths show. Columns of other names are ignored. Result: ``scope``, ``node``, ``label``, root_id (a label),
    depth, path (labels joined by "/"), descendants, chain.

    chain is "ok"; "cycle" for a node that comes back to itself; "below" for one whose chain runs into a cycle. The latter two have root_id and
    path "" and depth -1; the descendants of a node in a cycle are the other members and all nodes below any of them.
    With ``intervals``, ``root`` is the root's node, and ``first`` and ``last`` number the nodes of a root's tree so that a node and its descendants are those from its first to its last; a
    chain's nodes follow each other. Null for nodes that have no root. See ``below``.
    Null scopes are a scope of their own; rows with a null node are left out; an empty table gives an empty result.

    How: pointer doubling over the parent links, in rounds of one join and one aggregation, gives root, depth and the subtree sizes; a node
    that is still on its way after as many steps as there can be is in or below a cycle. In the rest the child with the largest subtree carries
    its parent's chain on, so any path crosses at most log2(n) chains, and a path is the path to the chain's head plus a piece of the chain.
    Rounds: log2(depth) and log2(n), whatever the shape. A parent with a third of all nodes below it is a skewed side of a join that adaptive
    execution splits; all grouping by parent is pre-aggregated.
    """
    spark = nodes.sparkSession
    n = nodes.where(F.col(node).isNotNull()).select(F.coalesce(F.col(scope).cast("string"), F.lit("\u0000")).alias("s"), F.col(scope).alias("scope"), F.col(node).cast("string").alias("v"), F.col(parent).cast("string").alias("p"), F.col(label).alias("l"))
    known = n.select("s", F.col("v").alias("p"), F.lit(True).alias("has"))
    # jump: the node 2^k steps above, null beyond the root; top: the root, once reached; least: the smallest node of the steps so far.
    st = cut(n.join(known, ["s", "p"], "left").select("s", "scope", "v", "l", F.when(F.col("has"), F.col("p")).alias("p")))
    base = st
    st = st.select("s", "v", F.col("p").alias("jump"), F.when(F.col("p").isNotNull(), 1).otherwise(0).cast("long").alias("dist"), F.when(F.col("p").isNull(), F.col("v")).alias("top"), F.lit(1).cast("long").alias("size"), F.col("v").alias("least"))
    lost, left = None, None
    while True:
        known_st = st
        under = st.where("jump is not null").groupBy("s", F.col("jump").alias("v")).agg(F.sum("size").alias("more"))
        target = st.select("s", F.col("v").alias("jump"), F.col("jump").alias("t_jump"), F.col("dist").alias("t_dist"), F.col("top").alias("t_top"), F.col("least").alias("t_least"))
        going = st.where("jump is not null").join(target, ["s", "jump"], "left")
        moved = going.select("s", "v", F.col("t_jump").alias("jump"), (F.col("dist") + F.col("t_dist")).alias("dist"), F.col("t_top").alias("top"), "size", F.least("least", "t_least").alias("least"))
        st = moved.unionByName(st.where("jump is null")).join(under, ["s", "v"], "left").select("s", "v", "jump", "dist", "top", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"), "least")
        st, before = cut(st, known_st, left=F.count("jump")), left
        left = told(st, "left")
        if not left:
            done = st
            break
        if lost is None and left == before:
            # A finite chain that goes on has nodes at every distance from its root, so some end in every round. None ended: the rest is in or below cycles.
            done, lost, steps = st.where("jump is null"), left, 1
            st = cut(base.join(st.where("jump is not null").select("s", "v"), ["s", "v"], "left_semi").select("s", "v", F.col("p").alias("jump"), F.lit(1).cast("long").alias("dist"), F.lit(None).cast("string").alias("top"), F.lit(1).cast("long").alias("size"), F.col("v").alias("least")))
        elif lost is not None:
            # No cycle, and no chain below one, has more nodes than these.
            steps *= 2
            if steps >= lost:
                done = done.unionByName(st)
                break
    ends = st.where("jump is not null").select("s", F.col("jump").alias("v")).distinct().withColumn("in_cycle", F.lit(True)) if left else None
    full = done.join(base, ["s", "v"])
    ok = full.where("top is not null")

    # Chains: the child with the largest subtree (then the smallest id) goes on with its parent's chain.
    heavy = ok.where("p is not null").groupBy("s", F.col("p").alias("v")).agg(F.min(F.struct((-F.col("size")).alias("n"), F.col("v"))).alias("h")).select("s", F.col("v").alias("p"), F.col("h.v").alias("heavy"), (-F.col("h.n")).alias("heavy_size"))
    chained = ok.join(heavy, ["s", "p"], "left").select("s", "scope", "v", "l", "p", "dist", "top", "size", "heavy_size", (F.coalesce(F.col("heavy") == F.col("v"), F.lit(False))).alias("goes_on"))
    chained = cut(chained)
    # The head of each chain, by doubling along the heavy links.
    hd = chained.select("s", "v", F.when(F.col("goes_on"), F.col("p")).alias("jump"), F.when(F.col("goes_on"), 1).otherwise(0).cast("long").alias("pos"), F.when(~F.col("goes_on"), F.col("v")).alias("head"))
    hd = cut(hd, left=F.count("jump"))
    while told(hd, "left"):
        t = hd.select("s", F.col("v").alias("jump"), F.col("jump").alias("t_jump"), F.col("pos").alias("t_pos"), F.col("head").alias("t_head"))
        hd = cut(hd.where("jump is not null").join(t, ["s", "jump"], "left").select("s", "v", F.col("t_jump").alias("jump"), (F.col("pos") + F.col("t_pos")).alias("pos"), F.col("t_head").alias("head")).unionByName(hd.where("jump is null")), hd, left=F.count("jump"))
    placed = cut(chained.join(hd.select("s", "v", "pos", "head"), ["s", "v"]))
    # A chain's labels in order. They are no longer than the path of its last node, which the result holds anyway.
    chains = placed.groupBy("s", "head").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "l"))), lambda x: x["l"]).alias("ids"))
    heads = placed.where("pos = 0").select("s", F.col("v").alias("head"), F.col("p").alias("above"), F.lit(0).cast("long").alias("off"))
    if intervals:
        # A chain begins behind the node it hangs on, that node's heavy child's tree, and the trees of the larger other children.
        light = placed.where("pos = 0").select("s", "v", F.col("p").alias("above"), "size", "heavy_size", (-F.col("size")).alias("_size"))
        light = running_sum(light.where("above is not null"), ["s", "above"], ["_size", "v"], "size", "sum")
        heads = heads.drop("off").join(light.select("s", F.col("v").alias("head"), (F.col("sum") + F.col("heavy_size") + 1).alias("off")), ["s", "head"], "left")
    over = placed.select("s", F.col("v").alias("above"), F.col("head").alias("over"), F.col("pos").alias("over_pos"))
    chains = cut(chains.join(heads, ["s", "head"]).join(over, ["s", "above"], "left").select("s", "head", "ids", "over", "over_pos", F.coalesce("off", F.lit(0)).alias("off")))
    paths_of = level = cut(chains.where("over is null").select("s", "head", F.lit("").alias("prefix"), "ids", F.lit(0).cast("long").alias("start")))
    # A chain hangs on one other, so each round finds the chains one level further down.
    while told(level):
        up = level.select("s", F.col("head").alias("over"), F.col("prefix").alias("u_prefix"), F.col("ids").alias("u_ids"), F.col("start").alias("u_start"))
        level = cut(chains.join(up, ["s", "over"]).select("s", "head", F.concat("u_prefix", F.array_join(F.expr("slice(u_ids, 1, int(over_pos) + 1)"), "/"), F.lit("/")).alias("prefix"), "ids", (F.col("u_start") + F.col("over_pos") + F.col("off")).alias("start")))
        paths_of = paths_of.unionByName(level)
    paths = placed.join(paths_of, ["s", "head"]).join(base.select("s", F.col("v").alias("top"), F.col("l").alias("root_id")), ["s", "top"])
    out = paths.select(F.col("scope").alias(scope), F.col("v").alias(node), F.col("l").alias(label), "root_id", F.col("dist").cast("int").alias("depth"), F.concat("prefix", F.array_join(F.expr("slice(ids, 1, int(pos) + 1)"), "/")).alias("path"), (F.col("size") - 1).cast("int").alias("descendants"), F.lit("ok").alias("chain"), *([F.col("top").alias("root"), (F.col("start") + F.col("pos")).alias("first"), (F.col("start") + F.col("pos") + F.col("size") - 1).alias("last")] if intervals else []))
    if ends is None:
        return out
    lost = full.where("top is null").join(ends, ["s", "v"], "left")
    of = lost.where("in_cycle").select("s", F.col("v").alias("jump"), F.col("least").alias("cycle"))
    lost = lost.join(of, ["s", "jump"], "left")
    total = lost.groupBy("s", "cycle").agg(F.count("*").alias("members"))
    lost = lost.join(total, ["s", "cycle"], "left")
    inside = F.coalesce("in_cycle", F.lit(False))
    return out.unionByName(
        lost.select(F.col("scope").alias(scope), F.col("v").alias(node), F.col("l").alias(label), F.lit("").alias("root_id"), F.lit(-1).alias("depth"), F.lit("").alias("path"), F.when(inside, F.col("members") - 1).otherwise(F.col("size") - 1).cast("int").alias("descendants"), F.when(inside, "cycle").otherwise("below").alias("chain")),
        allowMissingColumns=intervals,
    )


def below(ranged: DataFrame, scope: str, node: str) -> DataFrame:
    """(scope, node, descendant): every descendant of every node, from a hierarchy with ``intervals`` (of which root, first and last are read).

    Both sides meet by equality: an interval is cut into the few blocks of a power of two that make it up, and a node stands in one block of each size. So the
    work follows the number of pairs, however large a tree is.
    """
    rows = ranged.where("first is not null").select(F.col(scope).alias("s"), F.col(node).alias("v"), F.col("root").alias("r"), "first", "last")
    most = rows.agg(F.coalesce(F.max("last"), F.lit(0)).alias("n")).first()["n"].bit_length()
    start = "named_struct('lo', first + 1, 'hi', last, 'out', cast(array() as array<struct<k:int,b:bigint>>))"
    out = "concat(a.out, if(a.lo <= a.hi and a.lo % 2 = 1, array(named_struct('k', k, 'b', a.lo)), cast(array() as array<struct<k:int,b:bigint>>)), if(a.lo + a.lo % 2 <= a.hi and a.hi % 2 = 0, array(named_struct('k', k, 'b', a.hi)), cast(array() as array<struct<k:int,b:bigint>>)))"
    step = f"named_struct('lo', if(a.lo <= a.hi, (a.lo + a.lo % 2) div 2, 1L), 'hi', if(a.lo <= a.hi, (a.hi - 1 + a.hi % 2) div 2, 0L), 'out', {out})"
    cover = F.expr(f"aggregate(sequence(0, {most}), {start}, (a, k) -> {step}, a -> a.out)")
    blocks = rows.where("last > first").select("s", "r", "v", F.explode(cover).alias("x")).select("s", "r", "v", "x.k", "x.b")
    places = rows.select("s", "r", F.col("v").alias("d"), F.posexplode(F.expr(f"transform(sequence(0, {most}), k -> shiftright(first, k))")).alias("k", "b"))
    on = [F.col("x.s").eqNullSafe(F.col("y.s"))] + [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("r", "k", "b")]
    return blocks.alias("x").join(places.alias("y"), on).select(F.col("x.s").alias(scope), F.col("x.v").alias(node), F.col("y.d").alias("descendant"))


def feed_hierarchy(feed: DataFrame, intervals: bool = False) -> DataFrame:
    """identity_feed to source_id, id, root_id, depth, path, descendants, chain: one row per source and id, from its latest delivery."""
    rows = feed.select("source_id", whole_number(F.col("id")).alias("node"), F.col("id").alias("shown"), whole_number(F.col("managerId")).alias("manager"), "modified", "loaded_at", "record_id")
    rows = latest_delivery(rows.where("node is not null"), ["source_id", "node"], ["modified", "loaded_at", "record_id"], ["shown", "manager"])
    out = hierarchy(rows, "source_id", "node", "manager", "shown", intervals)
    return out.select("source_id", F.col("shown").alias("id"), "root_id", "depth", "path", "descendants", "chain", *(["root", "first", "last"] if intervals else []))
