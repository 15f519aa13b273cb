"""Reading tables of a folder, one Parquet file or folder each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mergetide.session import ship


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table ``name``; with ``columns``, only those are scanned."""
    ship(spark)
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*[df[c] for c in columns]) if columns else df
