"""JSON deliveries with fixed schemas: segment files, page files, rules, titles, resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT = "id string, type string, page int, anchor string, section string, section_title string, text string, normative_keywords array<string>, profile string"
SEGMENT_FILE = f"norm string, version string, source_pdf string, segmented_at string, segment_count int, segments array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>"
PAGE_FILE = "norm string, shortname string, shortnameSource string, version string, page_count int, pages array<struct<page_nr:int,anchor:string,section:string,section_title:string,text_clean:string>>"
RULE = "stem string, gap_threshold int, merge_endings array<string>, no_merge_starts array<string>, tuned_at string, method string"
TITLE = "etsiNumber string, wkiId string, shortTitle string, shortTitleSource string, fullTitleWorkitem string, fullTitlePdf string, generatedAt string"
RESOURCE = "id string, type string, label string, url string, format string, scope string, stf string, wki_ids array<string>, note string, source_file string, ingested_at string"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that can't be read come out as rows of nulls, as does what a file lacks."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("source_file", F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"(\.segments)?\.json$", ""))


def segment_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, norm, version, pos, and the segment's fields); a missing norm is the file's stem, a missing version ''.
    A file without segments gives one row without a pos."""
    doc = _json(spark, path, SEGMENT_FILE)
    norm = F.coalesce("norm", "source_file")
    return doc.select("source_file", norm.alias("norm"), F.coalesce("version", F.lit("")).alias("version"), F.posexplode_outer("segments").alias("pos", "s")).select("source_file", "norm", "version", "pos", "s.*")


def page_files(spark: SparkSession, path: str) -> DataFrame:
    doc = _json(spark, path, PAGE_FILE)
    return doc.select("source_file", "norm", "version", "page_count", F.inline("pages"))


def rules(spark: SparkSession, path: str, stems: DataFrame) -> DataFrame:
    """stems with gap_threshold, merge_endings, no_merge_starts: learned ones, else the defaults."""
    learned = _json(spark, path, RULE).where("stem IS NOT NULL").drop("source_file")
    empty = F.array().cast("array<string>")
    return stems.join(learned, "stem", "left").select(*stems.columns, F.coalesce("gap_threshold", F.lit(20)).alias("gap_threshold"), F.coalesce("merge_endings", empty).alias("merge_endings"), F.coalesce("no_merge_starts", empty).alias("no_merge_starts"))


def titles(spark: SparkSession, path: str) -> DataFrame:
    """One title a number, the last file's; numbers are compared without blanks and hyphens."""
    key = F.upper(F.regexp_replace("etsiNumber", r"[\s-]", ""))
    return _json(spark, path, TITLE).where("etsiNumber <> ''").groupBy(key.alias("key")).agg(F.max_by(F.struct("etsiNumber", "shortTitle", "shortTitleSource", "wkiId"), "source_file").alias("t")).select("key", "t.*")


def resources(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Usable resources, and the deliveries without an id."""
    rows = spark.read.schema(RESOURCE).option("multiLine", True).json(path)
    return rows.where("id IS NOT NULL"), rows.where("id IS NULL")


TOC_FILE = "stem string, title string, date string, body_starts_page int, total_pages int, toc_pages array<int>, boilerplate array<string>, toc array<struct<num:string,title:string,page:int,annex_type:string,boilerplate:boolean>>"


def toc_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents, and their contents entries (stem, pos, num, title, page, annex_type, boilerplate)."""
    docs = _json(spark, path, TOC_FILE).withColumn("stem", F.coalesce("stem", "source_file"))
    return docs.drop("toc", "source_file"), docs.select("stem", F.posexplode("toc").alias("pos", "e")).select("stem", "pos", "e.*")
