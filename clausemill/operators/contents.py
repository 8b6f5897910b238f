"""Tables of contents of paged texts: their lines, their pages, where the body begins, and the sections they describe.

Defined results: null texts have no lines; documents without a contents page have none, and their body is looked for from
page FIRST_BODY on; a document without a scope heading has a null body start; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.functions.text import cross_references, normative_keywords, stitched, strip, toc_entry
from clausemill.operators.sections import section_class
from clausemill.operators.sequences import section_neighbours
from clausemill.plans.session import materialize

THRESHOLD, FIRST_BODY = 3, 4
# Headings that stand between the contents and the body; words that begin a cover's other lines; months.
BETWEEN = ("intellectual property rights", "foreword", "modal verbs terminology", "introduction")
NOT_A_TITLE = r"^(ETSI|Draft|Final|V\d|(EN|TS|TR)\s)"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def has_leader(line: Column) -> Column:
    """Three dots in a row, or four dots and blanks."""
    return line.contains("...") | line.rlike(r"[. ]{4}")


def page_lines(pages: DataFrame) -> DataFrame:
    """(doc, page, pos, line) of pages (doc, page, at, text): trimmed lines that aren't empty, pos ordered within the page.

    Long runs of blanks become two, but for lines with a leader, whose blanks tell something.
    """
    raw = pages.select("doc", "page", "at", F.posexplode(F.split("text", "\n")).alias("k", "raw"))
    line = strip(F.col("raw"))
    kept = F.when(has_leader(line), line).otherwise(F.regexp_replace(line, " {3,}", "  "))
    return raw.select("doc", "page", F.struct("at", "k").alias("pos"), kept.alias("line")).where("line <> ''")


def parsed(lines: DataFrame) -> DataFrame:
    """lines with e, what they're read as, written once: everything here that is asked of lines reads it from there."""
    return materialize(lines.withColumn("e", toc_entry(F.col("line"))), "contents-lines")


def _entry(lines: DataFrame) -> Column:
    return F.col("e") if "e" in lines.columns else toc_entry(F.col("line"))


def line_flags(lines: DataFrame) -> DataFrame:
    """Lines with what speaks for their being contents lines: a number at the end, a leader, what they're read as."""
    t = F.col("line")
    return lines.select("doc", "page", "pos", t.rlike(r"\s\d{1,4}$").alias("trailing_number"), has_leader(t).alias("leader"), _entry(lines)["form"].alias("form"))


def entries(lines: DataFrame) -> DataFrame:
    """(doc, page, pos, num, title, to_page, annex_type, form): the contents lines."""
    return lines.select("doc", "page", "pos", _entry(lines).alias("e")).where("e IS NOT NULL").select("doc", "page", "pos", "e.num", "e.title", F.col("e.page").alias("to_page"), "e.annex_type", "e.form")


def contents_pages(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc, page, n_entries): the first page with `threshold` contents lines, and the pages after it up to one with none."""
    per = lines.groupBy("doc", "page").agg(F.count_if(_entry(lines).isNotNull()).alias("n_entries"))
    first = per.where(F.col("n_entries") >= threshold).groupBy("doc").agg(F.min("page").alias("first"))
    later = per.join(first, "doc").where(F.col("page") >= F.col("first"))
    stop = later.where("n_entries = 0").groupBy("doc").agg(F.min("page").alias("stop"))
    return later.join(stop, "doc", "left").where(F.col("stop").isNull() | (F.col("page") < F.col("stop"))).select("doc", "page", "n_entries")


def cover(lines: DataFrame) -> DataFrame:
    """(doc, cover_title, date) of each document's first page."""
    t = F.col("line")
    date = F.regexp_extract(t, rf"\b((?:{MONTHS})\s+\d{{4}})\b", 1)
    per = lines.groupBy("doc", "page").agg(F.min_by("line", F.when(~t.rlike(NOT_A_TITLE), F.col("pos"))).alias("cover_title"), F.min_by(date, F.when(date != "", F.col("pos"))).alias("date"))
    return per.groupBy("doc").agg(F.min_by(F.struct("cover_title", "date"), "page").alias("c")).select("doc", "c.*")


def structure(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc, total_pages, n_entries, toc_pages, body_start, between, cover_title, date).

    body_start is the first page after the contents with the heading of clause 1, Scope; between are the usual headings that
    stand before it, once each in the order of their first line, compared without case.
    """
    lines = lines if "e" in lines.columns else parsed(lines)
    toc = contents_pages(lines, threshold).groupBy("doc").agg(F.sum("n_entries").alias("n_entries"), F.sort_array(F.collect_list("page")).alias("toc_pages"))
    docs = lines.groupBy("doc").agg(F.count_distinct("page").alias("total_pages")).join(toc, "doc", "left")
    after = F.coalesce(F.array_max("toc_pages") + 1, F.lit(FIRST_BODY))
    low = F.lower("line")
    told = lines.where(low.isin(*BETWEEN) | low.rlike(r"^1\.?\s+scope\b")).join(docs.select("doc", after.alias("after")), "doc").where(F.col("page") >= F.col("after"))
    place = F.struct("page", "pos")
    start = told.where(low.rlike(r"^1\.?\s+scope\b")).groupBy("doc").agg(F.min(place).alias("start"))
    usual = told.where(low.isin(*BETWEEN)).groupBy("doc", low.alias("heading")).agg(F.min(place).alias("at"))
    before = usual.join(start, "doc", "left").where(F.col("start").isNull() | (F.col("at") < F.col("start")))
    listed = before.groupBy("doc").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "heading"))), lambda x: x["heading"]).alias("between"))
    return docs.join(start, "doc", "left").join(listed, "doc", "left").join(cover(lines), "doc", "left").select(
        "doc", "total_pages", F.coalesce("n_entries", F.lit(0)).alias("n_entries"), "toc_pages", F.col("start.page").alias("body_start"), "between", "cover_title", "date"
    )


def heading_frequencies(structures: DataFrame) -> DataFrame:
    """(heading, documents): how many documents have each usual heading between contents and body."""
    return structures.select(F.explode("between").alias("heading")).groupBy("heading").agg(F.count("*").alias("documents"))


def start_histogram(structures: DataFrame) -> DataFrame:
    """(body_start, documents)."""
    return structures.where("body_start IS NOT NULL").groupBy("body_start").agg(F.count("*").alias("documents"))


def report(structures: DataFrame, contents: DataFrame) -> DataFrame:
    """(part, pos, line): the lines of a Markdown report; write sorted by part and pos. Its size is that of the contents."""
    top = contents.where(F.col("num").rlike(r"^\d+$") | F.col("num").startswith("Annex "))
    title = top.groupBy("title").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title").limit(40).select(F.lit(1).alias("part"), F.format_string("%010d %s", 10_000_000_000 - F.col("n"), "title").alias("pos"), F.format_string("- %d x %s", "n", "title").alias("line"))
    usual = heading_frequencies(structures).select(F.lit(2), F.col("heading"), F.format_string("- %d x %s", "documents", "heading"))
    starts = start_histogram(structures).select(F.lit(3), F.format_string("%08d", "body_start"), F.format_string("- page %d: %d documents", "body_start", "documents"))
    docs = structures.select(F.lit(4), F.col("doc"), F.format_string("### %s (body p.%s, %d pp.)", "doc", F.coalesce(F.col("body_start").cast("string"), F.lit("?")), "total_pages"))
    return title.union(usual).union(starts).union(docs)


def sections(contents: DataFrame, pages: DataFrame) -> DataFrame:
    """Sections as their table of contents describes them, with the text of their pages.

    contents (doc, num, title, to_page), pages (doc, page, text; one row a page). Sections that share a page each get it.
    Returns id, doc, num, title, page_from, page_to, parent_num, prev_id, next_id, kind, text, keywords, cross_refs,
    chars_in_pages, chars_extracted and ratio. A number that comes twice in a document counts once, by its first page.
    """
    last = pages.groupBy("doc").agg(F.max("page").alias("last_page"))
    own = contents.groupBy("doc", "num").agg(F.min(F.struct("to_page", "title")).alias("m")).select("doc", "num", F.col("m.to_page").alias("page_from"), "m.title", F.concat_ws("#", "doc", "num").alias("id"))
    placed = own.join(last, "doc")
    around = section_neighbours(placed)
    ranged = placed.join(around, "id")
    spelled = ranged.select("id", "doc", F.explode(F.sequence("page_from", "page_to")).alias("page"))
    texts = spelled.join(pages.select("doc", "page", "text"), ["doc", "page"]).groupBy("id").agg(
        stitched(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda p: p["text"])).alias("text"), F.sum(F.length("text")).alias("chars_in_pages")
    )
    out = ranged.join(texts, "id", "left")
    t = F.coalesce("text", F.lit(""))
    return out.select(
        "id", "doc", "num", "title", "page_from", "page_to", "parent_num", "prev_id", "next_id", section_class(F.col("title"), F.col("num")).alias("kind"), t.alias("text"),
        normative_keywords(t).alias("keywords"), cross_references(t).alias("cross_refs"), F.coalesce("chars_in_pages", F.lit(0)).alias("chars_in_pages"), F.length(t).alias("chars_extracted"),
        F.round(F.length(t) / F.greatest(F.coalesce("chars_in_pages", F.lit(0)), F.lit(1)), 3).alias("ratio"),
    )
