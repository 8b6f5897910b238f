"""Profiles and quality gates of the segment corpus: one aggregation each, combined map-side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import is_boilerplate, placeholders

ENOUGH_MEDIAN, ENOUGH_ROWS, ENOUGH_EMBEDDED = 150, 1000, 0.95
BLANK_CHARS, LEAST_DENSITY = 50, 100


def type_profile(segments: DataFrame) -> DataFrame:
    """Per type: count, files, mean length, share of boilerplate, variation of lengths, and what to do about the type."""
    n = F.length("text")
    out = segments.groupBy("type").agg(
        F.count("*").alias("n"), F.count_distinct("source_file").alias("files"), F.avg(n).alias("avg_len"),
        F.avg(is_boilerplate(F.col("text")).cast("int")).alias("boilerplate"), (F.stddev_samp(n) / F.greatest(F.avg(n), F.lit(1.0))).alias("cv"),
    )
    verdict = F.when(F.col("boilerplate") > 0.8, "static").when(F.col("cv") > 0.4, "review").otherwise("low-variance")
    return out.withColumn("verdict", verdict)


def repeated_texts(segments: DataFrame, top: int = 200) -> DataFrame:
    """The texts found in more than one file, most frequent first (a top-k report)."""
    out = segments.where("text IS NOT NULL").groupBy(F.md5("text").alias("hash")).agg(F.count("*").alias("n"), F.count_distinct("source_file").alias("files"), F.min("text").alias("sample"))
    return out.where("files > 1").orderBy(F.desc("n"), "hash").limit(top)


def template_frequencies(segments: DataFrame) -> DataFrame:
    """Texts that differ only in numbers, dates and versions, counted together."""
    return segments.where("text IS NOT NULL").groupBy("type", placeholders(F.col("text")).alias("template")).agg(F.count("*").alias("n")).where("n > 1")


def repeated_ingests(docs: DataFrame) -> DataFrame:
    return docs.where("norm IS NOT NULL").groupBy("norm", "version").agg(F.count("*").alias("n")).where("n > 1")


def length_quantiles(segments: DataFrame) -> DataFrame:
    """Per type: median length, and the lengths at the index n/10 and 9n/10 of the sorted list.

    Lengths are few distinct values, so they are counted first; the ranks come from the running sum of the counts.
    """
    counts = segments.where("text IS NOT NULL AND type IS NOT NULL").groupBy("type", F.length("text").alias("len")).agg(F.count("*").alias("k"))
    w = Window.partitionBy("type").orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("upto", F.sum("k").over(w)).withColumn("n", F.sum("k").over(Window.partitionBy("type")))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col("len")))
    n = F.col("n")
    return ranked.groupBy("type").agg(
        F.max("n").alias("n"), ((at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2).alias("median"),
        at(F.floor(n / 10)).alias("p10"), at(F.floor(n * 9 / 10)).alias("p90"), F.sum(F.when(F.col("len") < 100, F.col("k")).otherwise(0)).alias("short"),
    )


def embedding_gaps(segments: DataFrame, top: int = 5) -> DataFrame:
    """The standards with the most rows still to be embedded (a top-k report)."""
    rows = segments.where(F.col("type").isin("NORM", "INFORM") & F.col("norm").isNotNull())
    out = rows.groupBy("norm").agg(F.count("*").alias("total"), F.sum("has_embedding").alias("embedded"))
    return out.withColumn("gap", F.col("total") - F.col("embedded")).where("gap > 0").orderBy(F.desc("gap"), "norm").limit(top)


def document_metrics(segments: DataFrame) -> DataFrame:
    """Per file: rows by type, density of headings, share of rows with a section, share of normative rows, warnings."""
    of = lambda t: F.count_if(F.col("type") == t)
    out = segments.where("source_file IS NOT NULL").groupBy("source_file").agg(
        F.count("*").alias("n"), of("NORM").alias("norm_rows"), of("INFORM").alias("inform_rows"), of("SECTION").alias("section_rows"),
        F.count_if(F.coalesce("section", F.lit("")) != "").alias("sectioned"),
    )
    ratio = lambda a: F.round(F.col(a) / F.col("n"), 6)
    warnings = F.array_compact(F.array(F.when(F.col("section_rows") == 0, "no headings"), F.when(F.col("norm_rows") == 0, "no requirements"), F.when(F.col("sectioned") < 0.5 * F.col("n"), "few sections")))
    return out.select("source_file", "n", ratio("section_rows").alias("heading_density"), ratio("sectioned").alias("section_coverage"), ratio("norm_rows").alias("norm_ratio"), F.array_join(warnings, "; ").alias("warnings"))


def ingest_findings(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(source_file, findings, status): what each delivered document's record, and what its pages, lack.

    pages (source_file, page, text, section), in any number of rows a page. A document with few pages is an error; one
    without any page is judged by its record alone.
    """
    per = pages.where("source_file IS NOT NULL AND page IS NOT NULL").groupBy("source_file", "page").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.max(F.coalesce("section", F.lit("")) != "").alias("sectioned"))
    seen = per.groupBy("source_file").agg(F.avg((F.col("chars") < BLANK_CHARS).cast("int")).alias("__blank"), F.avg("chars").alias("__density"), F.avg(F.col("sectioned").cast("int")).alias("__sectioned"))
    d = docs.join(seen, "source_file", "left")
    found = F.array_compact(F.array(
        F.when(F.col("version").isNull() | (F.col("version") == "vX.X.X"), "no version"), F.when(F.col("norm").isNull() | (F.col("norm") == F.col("source_file")), "no norm"),
        F.when(F.coalesce("shortname", F.lit("")) == "", "no shortname"), F.when(F.coalesce("page_count", F.lit(0)) < 3, "few pages"),
        F.when(F.col("__blank") > 0.3, "blank pages"), F.when(F.col("__density") < LEAST_DENSITY, "little text"), F.when(F.col("__sectioned") < 0.1, "few sections"),
    ))
    status = F.when(F.array_contains(found, "few pages"), "error").when(F.size(found) > 0, "warn").otherwise("ok")
    return d.select("source_file", F.array_join(found, "; ").alias("findings"), status.alias("status")).distinct()


def ingest_summary(findings: DataFrame) -> DataFrame:
    """(ok, warn, error, no_shortname)."""
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    return findings.agg(of("ok"), of("warn"), of("error"), F.count_if(F.col("findings").contains("no shortname")).alias("no_shortname"))


def health(segments: DataFrame) -> DataFrame:
    """(check, value, ok): the corpus gates."""
    counts = length_quantiles(segments.where(F.col("type").isin("NORM", "INFORM")).withColumn("type", F.lit("x"))).select("n", "median")
    emb = segments.where(F.col("type").isin("NORM", "INFORM")).agg((F.sum("has_embedding") / F.count("*")).alias("e"))
    row = counts.join(F.broadcast(emb))
    return row.select(F.inline(F.array(
        F.struct(F.lit("segments").alias("check"), F.col("n").cast("double").alias("value"), (F.col("n") >= ENOUGH_ROWS).alias("ok")),
        F.struct(F.lit("median length").alias("check"), F.col("median").cast("double").alias("value"), (F.col("median") >= ENOUGH_MEDIAN).alias("ok")),
        F.struct(F.lit("embedded").alias("check"), F.round("e", 6).alias("value"), (F.col("e") >= ENOUGH_EMBEDDED).alias("ok")),
    )))
