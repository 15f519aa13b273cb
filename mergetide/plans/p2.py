"""Problem 2: chains of managers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.operators.hierarchy import below, feed_hierarchy
from mergetide.sources import read_table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return feed_hierarchy(read_table(spark, folder, "identity_feed", "record_id", "source_id", "id", "managerId", "modified", "loaded_at"))


def p2_below(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows are below each row of a chain that ends, with the least and greatest id among them: from the pairs that the intervals give."""
    rows = feed_hierarchy(read_table(spark, folder, "identity_feed", "record_id", "source_id", "id", "managerId", "modified", "loaded_at"), intervals=True)
    pairs = below(rows, "source_id", "id")
    return pairs.groupBy("source_id", "id").agg(F.count("*").alias("n"), F.min("descendant").alias("least"), F.max("descendant").alias("greatest"))


P2_SQL = r"""
with recursive
spelled as (
  select record_id, source_id, id, regexp_replace(id, '^[\s\x{a0}\x{200b}\x{feff}]+|[\s\x{a0}\x{200b}\x{feff}]+$', '', 'g') as t,
    regexp_replace(managerId, '^[\s\x{a0}\x{200b}\x{feff}]+|[\s\x{a0}\x{200b}\x{feff}]+$', '', 'g') as m, modified, loaded_at
  from identity_feed),
named as (
  select record_id, source_id, id, modified, loaded_at,
    case when regexp_matches(t, '^\+?[0-9]+(\.0*)?$') then cast(cast(regexp_extract(t, '^\+?([0-9]+)', 1) as hugeint) as varchar) else nullif(t, '') end as node,
    case when regexp_matches(m, '^\+?[0-9]+(\.0*)?$') then cast(cast(regexp_extract(m, '^\+?([0-9]+)', 1) as hugeint) as varchar) else nullif(m, '') end as manager
  from spelled),
latest as (
  select source_id, node, id, manager from named where node is not null
  qualify row_number() over (partition by source_id, node order by modified desc nulls last, loaded_at desc nulls last, record_id desc) = 1),
nodes as (
  select a.source_id, a.node, a.id, b.node as parent from latest a left join latest b on a.source_id = b.source_id and a.manager = b.node),
down as (
  select source_id, node, id as root_id, 0 as depth, id as path from nodes where parent is null
  union all
  select n.source_id, n.node, d.root_id, d.depth + 1, d.path || '/' || n.id from nodes n join down d on n.source_id = d.source_id and n.parent = d.node),
up as (
  select source_id, node, parent as above from nodes where parent is not null
  union
  select u.source_id, u.node, n.parent from up u join nodes n on u.source_id = n.source_id and u.above = n.node where n.parent is not null),
under as (select source_id, above as node, count(*) filter (where above <> node) as descendants from up group by 1, 2),
looped as (select source_id, node from up where above = node)
select n.source_id, n.id, coalesce(d.root_id, '') as root_id, cast(coalesce(d.depth, -1) as integer) as depth, coalesce(d.path, '') as path,
  cast(coalesce(u.descendants, 0) as integer) as descendants, case when d.node is not null then 'ok' when l.node is not null then 'cycle' else 'below' end as chain
from nodes n left join down d on n.source_id = d.source_id and n.node = d.node left join under u on n.source_id = u.source_id and n.node = u.node
left join looped l on n.source_id = l.source_id and n.node = l.node
"""

BELOW_SQL = P2_SQL[: P2_SQL.index("under as (")] + """
pairs as (select u.source_id, u.above as node, u.node as other from up u join down d on d.source_id = u.source_id and d.node = u.node)
select p.source_id, a.id, count(*) as n, min(b.id) as least, max(b.id) as greatest
from pairs p join nodes a on a.source_id = p.source_id and a.node = p.node join nodes b on b.source_id = p.source_id and b.node = p.other group by 1, 2
"""

QUERIES = {"p2_found": p2_found, "p2_below": p2_below}
ORACLES = {"p2_found": P2_SQL, "p2_below": BELOW_SQL}
