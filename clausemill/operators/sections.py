"""Sections against pages: range joins, coverage, frequencies of titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Titles that are the same in every document, and notes.
USUAL = r"(?i)Intellectual Property|Essential patents|Important Notice|Modal verbs terminology|Foreword|Introduction"
NOTE = r"(?i)\(informative\)|^NOTE\b|^EXAMPLE\b"


def pages_in_sections(sections: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, n, chars): rows and characters on the pages of each section.

    sections (id, doc, page_from, page_to), pages (doc, page, text). Pages are summed up first; a section's pages are few,
    so the range is spelled out and joined by equality, which shuffles evenly where a range comparison would not.
    """
    per_page = pages.groupBy("doc", "page").agg(F.count("*").alias("k"), F.sum(F.length("text")).alias("c"))
    spelled = sections.where("page_to >= page_from").select("id", "doc", F.explode(F.sequence("page_from", "page_to")).alias("page"))
    return spelled.join(per_page, ["doc", "page"]).groupBy("id").agg(F.sum("k").alias("n"), F.sum("c").alias("chars"))


def coverage(covered: DataFrame, sections: DataFrame, enough: float = 0.85) -> DataFrame:
    """(doc, extracted, available, ratio, low): characters in sections against those on their pages."""
    both = sections.select("id", "doc", F.length("text").alias("own")).join(covered, "id")
    out = both.groupBy("doc").agg(F.sum("own").alias("extracted"), F.sum("chars").alias("available"))
    ratio = F.round(F.col("extracted") / F.greatest("available", F.lit(1)), 3)
    return out.withColumn("ratio", ratio).withColumn("low", ratio < enough)


def section_class(title: Column, num: Column) -> Column:
    return F.when(title.rlike(USUAL), "boilerplate").when(num.rlike(r"^(?i:annex\s+)?[A-Z](\.|$)"), "annex").when(title.rlike(NOTE), "inform").otherwise("norm")


def title_frequencies(toc: DataFrame, top: int = 40) -> DataFrame:
    """The most frequent top-level titles (a top-k report)."""
    rows = toc.where(F.col("title").isNotNull() & F.col("num").rlike(r"^(\d+|[A-Z])$"))
    return rows.groupBy("title").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title").limit(top)


def body_starts(toc: DataFrame) -> DataFrame:
    """(page, docs): on which page documents begin."""
    first = toc.where("page_from IS NOT NULL AND id IS NOT NULL").groupBy(F.substring_index("id", "#", 1).alias("doc")).agg(F.min("page_from").alias("page"))
    return first.groupBy("page").agg(F.count("*").alias("docs"))


def first_samples(segments: DataFrame, n: int = 3, key_chars: int = 200) -> DataFrame:
    """(type, row_nr): per type its first n texts that differ in their beginning (a sample by rank)."""
    own = segments.where("text IS NOT NULL AND type IS NOT NULL").groupBy("type", F.left("text", F.lit(key_chars)).alias("key")).agg(F.min("row_nr").alias("row_nr"))
    return own.withColumn("r", F.row_number().over(Window.partitionBy("type").orderBy("row_nr"))).where(F.col("r") <= n).select("type", "row_nr")


def file_medians(segments: DataFrame) -> DataFrame:
    """(files, median): the corpus median of each file's median length."""
    per = segments.where("text IS NOT NULL AND source_file IS NOT NULL AND type IN ('NORM', 'INFORM')").groupBy("source_file").agg(F.median(F.length("text")).alias("m"))
    return per.agg(F.count("*").alias("files"), F.median("m").alias("median"))
