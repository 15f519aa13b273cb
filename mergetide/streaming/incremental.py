"""Incremental runs: accounts that arrive in a stream are keyed, claimed and counted batch by batch.

An extension of the engine's batch runs, which carry the same state (claimed keys, counts per source) from one run to the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mergetide.functions.keys import account_key


def read_stream(spark: SparkSession, folder: str, like: DataFrame, files: int = 16) -> DataFrame:
    """New Parquet files of a folder, ``files`` at a time, with the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(folder)


def first_deliveries(accounts: DataFrame, at: str, late: str) -> DataFrame:
    """The first row of each account key; a key is forgotten, and a row too late is dropped, ``late`` after it."""
    keyed = accounts.withColumn("key", account_key(F.col("source_id"), F.col("native_identity"))).where("key is not null")
    return keyed.withWatermark(at, late).dropDuplicatesWithinWatermark(["key"])


def windowed_counts(rows: DataFrame, at: str, by: str, window: str, late: str) -> DataFrame:
    """How many rows each ``by`` has per window of time, late rows counted until ``late`` after the window."""
    return rows.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def claim_batches(accounts: DataFrame, claimed: str, checkpoint: str, then: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Each batch's accounts that no earlier batch claimed go to ``then`` and into the table ``claimed``, a folder partitioned by batch.

    A batch that is run again after a failure overwrites its own part and sees only the parts of earlier batches, so every key is claimed once.
    """
    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn("key", account_key(F.col("source_id"), F.col("native_identity"))).where("key is not null").dropDuplicates(["key"])
        try:
            before = spark.read.parquet(claimed).where(F.col("batch") < n)
            keyed = keyed.join(before.select("key"), "key", "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        keyed = keyed.persist()
        keyed.select("key").write.mode("overwrite").parquet(f"{claimed}/batch={n}")
        then(keyed, n)
        keyed.unpersist()

    return accounts.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
