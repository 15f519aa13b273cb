"""Sessions and the cutting of lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: What a session of this engine starts with. A cluster's own settings win, as these are only applied by ``build``.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build(master: str | None = None, app: str = "mergetide", **extra: str) -> SparkSession:
    """A session with DEFAULTS; ``extra`` holds settings with "__" for "."."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | {k.replace("__", "."): v for k, v in extra.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode, where none is named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="mergetide-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


_TABLES: dict[str, SparkSession] = {}


#: A table of more rows is never broadcast, however small its compressed files are: they say too little of its size in memory.
BROADCAST_ROWS = 20_000


def cut(df: DataFrame, *stale: DataFrame, **tally: Column) -> DataFrame:
    """df, written as a table to the shared checkpoint folder: later plans start from those files, and lost executors cost nothing but a read.

    Written once and compressed, where a checkpoint computes its last stage twice and compresses nothing. ``tally``: aggregates that are taken while the
    rows are written, in place of another job over them; ``told`` gives them. ``stale``: earlier results of this function that nothing needs any more;
    their files are removed. What is left goes when the driver ends. Joins of a table of more than BROADCAST_ROWS rows are merge joins.
    """
    spark = df.sparkSession
    ship(spark)
    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in tally.items()]).write.option("compression", "zstd").parquet(at)
    _TABLES[at] = spark
    for x in stale:
        drop(x)
    out, said = spark.read.schema(df.schema).parquet(at), seen.get
    if said["rows"] > BROADCAST_ROWS:
        out = out.hint("merge")
    out._table, out._told = at, said
    # Shuffle files of finished steps go when the driver collects its garbage; left to itself it may keep them all until the end.
    spark._jvm.System.gc()
    return out


def told(table: DataFrame, name: str = "rows") -> int:
    """A count, or another aggregate, that ``cut`` took of the table."""
    return table._told[name]


def drop(df: DataFrame) -> None:
    """Removes the files of a result of ``cut``."""
    at = getattr(df, "_table", None)
    spark = _TABLES.pop(at, None)
    if spark is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clean() -> None:
    for at, spark in list(_TABLES.items()):
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 the session has ended, and its folder with it
            return


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each application, so that it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="mergetide-py-")) / f"{root.name}.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(at))
