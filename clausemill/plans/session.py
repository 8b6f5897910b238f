"""Session defaults and the materialisation point that all multi-pass operators share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Broadcasts are only asked for below this many rows of a side whose rows have a bounded width.
BROADCAST_ROWS = 200_000
_written: list[str] = []
_released = 0


def build_session(name: str = "clausemill", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine is tested with; on a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or in local mode only, a fresh one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(spark.sparkContext, "_clausemill_shared", None)
    if own is None:
        own = spark.sparkContext._clausemill_shared = "file://" + tempfile.mkdtemp(prefix="clausemill-")
    return own


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors, computes once.

    With `by`, an int column, the table is laid out in one folder for each of its values, which filters on it select."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.repartition(by).write.partitionBy(by) if by else df.write).parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done: its cleaner only acts once the driver has collected garbage."""
    for _ in range(2):  # the first lets go of the plans, the second of what hung on them
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def release(spark: SparkSession) -> int:
    """Delete the tables this process has materialised, once no result that reads them is needed any more."""
    global _released
    _released += 1
    gone, jvm = 0, spark.sparkContext._jvm
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        gone += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def generation() -> int:
    """How often tables have been released: what is kept of them from one query to the next belongs to one generation."""
    return _released


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
