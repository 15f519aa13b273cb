"""Running numbers without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mergetide.session import cut


def running_number(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """df with ``name``: 1, 2, ... by ``order`` within ``by`` ([] for the whole table).

    The rows are split into ranges of the order; each range is numbered by itself, and starts after what the ranges before it hold. So a group that has all
    rows is numbered by as many tasks as there are ranges. ``order`` must name columns without nulls that are unique within a group.
    """
    parts = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = parts.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1) if by else Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("_range") == F.col("_r")]
    numbered = parts.withColumn("_k", F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))).join(starts, on)
    return numbered.withColumn(name, (F.col("_k") + F.col("_start")).cast("long")).drop("_range", "_k", "_r", "_start", *[f"_{c}" for c in by])


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """df with ``name``: the sum of ``value`` over the rows before, by ``order`` within ``by``; 0 for the first. Split into ranges as in running_number, with
    the same demands on ``order``."""
    parts = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = parts.groupBy(*by, "_range").agg(F.sum(value).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("_range") == F.col("_r")]
    inner = F.sum(value).over(Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn("_k", F.coalesce(inner, F.lit(0))).join(starts, on).withColumn(name, F.col("_k") + F.col("_start")).drop("_range", "_k", "_r", "_start", *[f"_{c}" for c in by])
