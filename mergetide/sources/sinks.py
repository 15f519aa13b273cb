"""Results as files: typed rows, reports with a summary, and the small state carried from run to run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_rows(rows: DataFrame, folder: str, kind: str = "parquet", by: list[str] | None = None) -> None:
    w = rows.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).format(kind).save(folder)


def write_report(summary: DataFrame, rows: DataFrame, folder: str) -> None:
    """summary/ and rows/ as JSON lines; the rows stay spread over files."""
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary")
    rows.write.mode("overwrite").json(f"{folder}/rows")


def save_state(state: DataFrame, folder: str) -> str:
    """Writes a version of the state and returns its folder; readers see the last version that was written to its end."""
    at = f"{folder}/v{uuid.uuid1().time:020d}"
    state.write.parquet(at)
    return at


def load_state(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The last complete version of the state; an empty table of ``schema`` if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    if fs.exists(path):
        done = sorted(s.getPath().toString() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    return spark.read.schema(schema).parquet(done[-1]) if done else spark.createDataFrame([], schema)


def counted(old: DataFrame, new: DataFrame, by: str, n: str) -> DataFrame:
    """The cumulative counts after a run."""
    return old.select(by, n).unionByName(new.select(by, n)).groupBy(by).agg(F.sum(n).alias(n))


def reset_state(spark: SparkSession, folder: str, schema: str) -> str:
    """Writes an empty version of the state, which readers see from then on."""
    return save_state(spark.createDataFrame([], schema), folder)
