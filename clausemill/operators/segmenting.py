"""Whole documents to segments: from word-processor paragraphs, and from the glyphs and tables of pages.

Both end in the same table: doc, id, type, page, section, section_title, text, keywords, markdown.

Defined results: empty paragraphs and blocks give no segment; a table needs two columns, two rows and LEAST_TABLE characters,
else it is none; documents without a profile have the first; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import normative_keywords, strip, table_markdown
from clausemill.operators import blocks as B
from clausemill.operators.classes import carried_sections, classified_blocks, contents_lines, paragraph_class
from clausemill.operators.sequences import contents_mode, paragraph_islands

LEAST_TABLE = 80


def cleaned_table(rows: Column) -> Column:
    """Rows of cells without nulls and without rows that are blank throughout."""
    cells = F.transform(rows, lambda r: F.transform(r, lambda c: strip(F.coalesce(c, F.lit("")))))
    return F.filter(cells, lambda r: F.exists(r, lambda c: c != ""))


def is_table(rows: Column) -> Column:
    """Whether cleaned rows make a table: two columns and two rows at least, and enough text."""
    chars = F.aggregate(F.flatten(rows), F.lit(0), lambda s, c: s + F.length(c))
    return (F.size(rows) >= 2) & (F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0)) >= 2) & (chars >= LEAST_TABLE)


def segment_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """Segments of paragraphs (doc, pos, kind, style, text, bold, rows) in body order, tables as Markdown beside their text."""
    rows = cleaned_table(F.col("rows"))
    typed = paragraphs.where(F.col("kind").isin("p", "tbl") & (strip(F.coalesce("text", F.lit(""))) != "")).withColumns({
        "type": F.when(F.col("kind") == "tbl", "TABLE").otherwise(paragraph_class(F.col("style"), F.col("text"), F.col("bold"))),
        "markdown": F.when((F.col("kind") == "tbl") & (F.size(rows) > 0), table_markdown(rows)),
    })
    w = Window.partitionBy("doc").orderBy("pos")
    name = F.concat("doc", F.when(F.col("kind") == "tbl", F.concat(F.lit("_tbl"), "pos")).otherwise(F.concat(F.lit("_pa"), "pos", F.lit("_b"), F.row_number().over(w))))
    out = carried_sections(typed).withColumn("id", name)
    return out.select("doc", "id", "type", F.lit(None).cast("int").alias("page"), "section", "section_title", strip(F.col("text")).alias("text"), normative_keywords(F.col("text")).alias("keywords"), "markdown", "pos")


def segment_pages(glyphs: DataFrame, tables: DataFrame, docs: DataFrame, gap: float = 20.0, is_heading: Callable[[Column], Column] | None = None) -> DataFrame:
    """Segments of glyphs (doc, page, text, top, bottom, x0, x1, size, fontname), tables (doc, page, bbox, rows), docs (doc, profile, height).

    Tables take their glyphs; the rest becomes blocks, without repeats, classified with the mode of their page, and
    paragraphs that go on are joined. On a page tables come first, and keep the section of the page before.
    """
    good = tables.withColumn("rows", cleaned_table(F.col("rows"))).where(is_table(F.col("rows")))
    cut = B.without_repeats(B.text_blocks(B.outside_boxes(glyphs, good), gap)).where(strip(F.col("text")) != "")
    modes = contents_mode(cut.groupBy("doc", "page").agg(F.sum(contents_lines(F.col("text"))).cast("int").alias("n_lines")))
    typed = classified_blocks(cut.join(docs, "doc").join(modes, ["doc", "page"], "left"), is_heading)
    pos = F.col("page").cast("bigint") * 1_000_000 + F.col("block") + 1
    placed = typed.select("doc", pos.alias("pos"), pos.alias("id"), "type", "text", "page")
    joined = paragraph_islands(placed.drop("page")).select("doc", F.col("first_id").alias("pos"), strip(F.col("text")).alias("text"))
    body = joined.join(placed.select("doc", "pos", "type", "page"), ["doc", "pos"]).withColumn("markdown", F.lit(None).cast("string"))
    at = F.col("page").cast("bigint") * 1_000_000 - 500_000 + F.row_number().over(Window.partitionBy("doc", "page").orderBy("bbox.top", "bbox.x0"))
    flat = F.array_join(F.transform("rows", lambda r: F.array_join(r, " | ")), "\n")
    framed = good.select("doc", at.alias("pos"), flat.alias("text"), F.lit("TABLE").alias("type"), "page", table_markdown(F.col("rows")).alias("markdown"))
    out = carried_sections(body.unionByName(framed))
    number = F.row_number().over(Window.partitionBy("doc", "page").orderBy("pos"))
    return out.select("doc", F.concat("doc", F.lit("_p"), "page", F.lit("_b"), number).alias("id"), "type", "page", "section", "section_title", "text", normative_keywords(F.col("text")).alias("keywords"), "markdown", "pos")


def zoned_text(glyphs: DataFrame, heights: DataFrame, header: float = 0.07, footer: float = 0.93) -> DataFrame:
    """(doc, page, body, edge, chars, body_chars): each page's text within its zones and at its edges, by the middle of glyphs."""
    mid = (F.col("top") + F.col("bottom")) / 2 / F.col("height")
    g = glyphs.join(heights, "doc").withColumn("inside", mid.between(header, footer)).withColumn("y", F.floor((F.col("top") + F.col("bottom")) / 2))
    text = lambda side: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("inside") == side, F.struct("y", "x0", "text")))), lambda c: c["text"]), "")
    return g.groupBy("doc", "page").agg(text(True).alias("body"), text(False).alias("edge"), F.sum(F.length("text")).alias("chars"), F.sum(F.when(F.col("inside"), F.length("text")).otherwise(0)).alias("body_chars"))


def distinct_images(images: DataFrame) -> DataFrame:
    """images (doc, page, content) with their hash, each content once a document, by its first page."""
    h = images.withColumn("sha", F.left(F.sha1("content"), F.lit(12)))
    first = h.groupBy("doc", "sha").agg(F.min("page").alias("page"))
    return h.join(first, ["doc", "sha", "page"], "left_semi").dropDuplicates(["doc", "sha", "page"])


def images_in_sections(images: DataFrame, sections: DataFrame) -> DataFrame:
    """(id, sha, page): the images on the pages of each section (id, doc, page_from, page_to); ranges are spelled out."""
    spelled = sections.where("page_to >= page_from").select("id", "doc", F.explode(F.sequence("page_from", "page_to")).alias("page"))
    return spelled.join(images.select("doc", "page", "sha"), ["doc", "page"]).select("id", "sha", "page")
