"""Files as tables: listing, kinds by content, and which of several files stands for a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, glob: str = "*", content: bool = True) -> DataFrame:
    """(path, name, stem, modified, length[, content]) of all files under root; dot files are left out."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    out = raw.select("path", name.alias("name"), F.lower(F.regexp_replace(name, r"\.[^.]*$", "")).alias("stem"), F.col("modificationTime").alias("modified"), "length", *(["content"] if content else []))
    return out.where(~F.col("name").startswith("."))


def sniffed_kind(content: Column) -> Column:
    head = F.substring(F.hex(F.substring(content, 1, 4)), 1, 8)
    return F.when(head == "25504446", "pdf").when(head == "504B0304", "docx").otherwise("unknown")


def prefer_pdf(files: DataFrame) -> DataFrame:
    """One file a stem: a PDF, else a word-processor file."""
    rank = F.when(F.lower("name").endswith(".pdf"), 0).otherwise(1)
    best = files.groupBy("stem").agg(F.min_by("path", F.struct(rank, "path")).alias("path"))
    return files.join(best.select("path"), "path", "left_semi")


def resolved_source(docs: DataFrame, files: DataFrame) -> DataFrame:
    """docs (stem, source_docx, source_pdf) with path: the named file, else the newest of that stem."""
    newest = files.groupBy("stem").agg(F.max_by("path", F.struct("modified", "name")).alias("__newest"))
    return docs.join(newest, "stem", "left").withColumn("path", F.coalesce("source_docx", "source_pdf", "__newest")).drop("__newest")


def crc_manifest(files: DataFrame) -> DataFrame:
    return files.select("path", F.lpad(F.lower(F.hex(F.crc32("content"))), 8, "0").alias("crc"))


def named_like(files: DataFrame, part: str) -> DataFrame:
    """The files whose name contains a part, without regard to case."""
    return files.where(F.lower("name").contains(part.lower()))


def page_files_of(docs: DataFrame, files: DataFrame) -> DataFrame:
    """docs (stem, source_kind, ...) that came from a PDF which is at hand, with its path."""
    newest = files.where(F.lower("name").endswith(".pdf")).groupBy("stem").agg(F.max_by("path", F.struct("modified", "name")).alias("path"))
    return docs.where("source_kind = 'pdf'").join(newest, "stem")


def latest_delivery(links: DataFrame) -> DataFrame:
    """(key, url): of each listing's links (key, href) the PDF of the highest version folder, the last by name of several."""
    version = F.transform(F.regexp_extract_all("href", F.lit(r"/(\d{2}\.\d{2}\.\d{2}(?:_\d+)?)/"), F.lit(1)), lambda v: v)
    pdf = links.where(F.lower("href").endswith(".pdf"))
    return pdf.groupBy("key").agg(F.max_by("href", F.struct(F.coalesce(F.try_element_at(version, F.lit(-1)), F.lit("")), "href")).alias("url"))
