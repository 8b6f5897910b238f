"""Newly arrived segment files, merged into a table by a stream that ends when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.sources.json_docs import SEGMENT_FILE


def arrivals(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    """The segments of files in folder, as a stream."""
    doc = spark.readStream.schema(SEGMENT_FILE).option("multiLine", True).option("maxFilesPerTrigger", files_a_batch).json(folder)
    stem = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"(\.segments)?\.json$", "")
    rows = doc.select(stem.alias("source_file"), "norm", "version", F.posexplode("segments").alias("pos", "s"))
    return rows.select("source_file", F.coalesce("norm", "source_file").alias("norm"), F.coalesce("version", F.lit("")).alias("version"), "pos", "s.*")


def index_arrivals(spark: SparkSession, folder: str, table_path: str, checkpoint: str) -> None:
    """Bring table_path up to the files in folder.

    The table is only appended to, one partition a batch; a batch that is run again after a failure overwrites its own
    partition, so nothing is written twice. `current` reads it.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.where(F.col("type").isin("NORM", "INFORM", "SECTION")).dropDuplicates(["source_file", "id"]).withColumn("batch", F.lit(number))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(table_path)

    stream = arrivals(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def current(spark: SparkSession, table_path: str) -> DataFrame:
    """Each file's segments as of its last delivery."""
    rows = spark.read.parquet(table_path)
    last = rows.groupBy("source_file").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["source_file", "batch"], "left_semi")
