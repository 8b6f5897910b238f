"""Where results go: tables partitioned by what they're read by, texts in order, histories that only grow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_specs(pages: DataFrame, path: str) -> None:
    """Page records, a folder for each standard; those of the standards at hand replace what is there."""
    pages.repartition("norm").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("norm").parquet(path)


def write_sections(sections: DataFrame, path: str) -> None:
    """Sections with their text, a folder for each document."""
    sections.repartition("doc").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc").parquet(path)


def write_warnings(coverage: DataFrame, path: str) -> None:
    """The documents whose coverage is low, as JSON lines."""
    coverage.where("low").coalesce(1).write.mode("overwrite").json(path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def graph_json(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, json): a graph's nodes and edges as JSON lines, for what reads the graph from a file."""
    n = nodes.select(F.lit("node").alias("part"), F.to_json(F.struct(*nodes.columns)).alias("json"))
    return n.unionByName(edges.select(F.lit("edge").alias("part"), F.to_json(F.struct(*edges.columns)).alias("json")))


def write_lines(lines: DataFrame, path: str) -> None:
    """lines (part, pos, line) as text files that are in order, and in order of one another."""
    lines.orderBy("part", "pos", "line").select("line").write.mode("overwrite").text(path)


def append_history(entry: DataFrame, path: str) -> None:
    entry.coalesce(1).write.mode("append").parquet(path)


def write_rules(rules: DataFrame, path: str) -> None:
    """Learned rules: a small table that is replaced as a whole."""
    rules.coalesce(1).write.mode("overwrite").json(path)


def append_missing(rows: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table at path doesn't hold yet, the first of each key; make the table if there is none."""
    spark = rows.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    new = rows.dropDuplicates([key])
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        new = new.join(spark.read.parquet(path).select(key), key, "left_anti")
    new.select(rows.columns).write.mode("append").parquet(path)
