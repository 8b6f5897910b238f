"""Queries of classes of texts, of how they are cut, and of merged runs, with their SQL.

The test tables hold no page geometry, so blocks stand where their type puts them: headers at the top, footers at the foot.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.operators import blocks, classes, merge, profiles
from clausemill.plans.session import table
from clausemill.queries_core import register

QUERIES, SQL = {}, {}
query = register(QUERIES, SQL)

_MODAL = r"(?i)\b(shall|should|must|required|recommended|may|optional)\b"
_NOTE, _CAPTION = r"(?i)(^|\n)\s*(note\b|example\b|\[i\.[0-9]+\])", r"(?i)^(figure|table)\s+[-0-9a-z]"
_TOCL = "len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^.{2,60}[. ]{4,}[0-9]{1,4}\\s*$')))"
_INF, _CAP = f"(regexp_matches(t, '{_NOTE}') OR contains(lower(t), '(informative)'))", f"regexp_matches(t, '{_CAPTION}')"
_REST = f"WHEN {_INF} THEN 'INFORM' WHEN {_CAP} THEN 'TABLE' WHEN regexp_matches(t, '{_MODAL}') THEN 'NORM' ELSE 'OTHER' END"
_HEAD = r"(regexp_matches(t, '^([A-Z]?\.?[0-9]+(\.[0-9]+)*\.?|[A-Z]\.?)\s+[A-Z][^\n]{2,80}$'))"
_T = "regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')"


def _rows(spark, d, *columns):
    return table(spark, d, "segments").select("row_nr", "text", *columns)


@query(f"SELECT row_nr, CASE WHEN {_TOCL} >= 1 THEN 'TOC' {_REST} AS class FROM (SELECT row_nr, {_T} AS t FROM segments WHERE text IS NOT NULL)")
def classes_quick(spark, d):
    return _rows(spark, d).where("text IS NOT NULL").select("row_nr", classes.quick_class(F.col("text")).alias("class"))


def _blocks(spark, d):
    at = F.when(F.col("type") == "HEADER", 20.0).when(F.col("type") == "FOOTER", 780.0).otherwise(400.0)
    big = F.col("type") == "SECTION"
    return _rows(spark, d, "type", "page", "profile").withColumns({
        "y_top": at, "y_bot": at + 12.0, "height": F.lit(800.0), "size": F.when(big, 14.0).otherwise(10.0), "bold": F.when(big & (F.col("page") % 2 == 0), 1.0).otherwise(0.0), "toc_mode": F.lit(False),
    }).drop("type")


def _zone(patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches(t, '{p}')" for p in patterns) + ")"


def _profile_sql(p) -> str:
    return f"""CASE WHEN top < {p.header_zone} AND ({_zone(p.header)} OR (page > 1 AND bot < 1.5 * {p.header_zone})) THEN 'HEADER' WHEN bot > 1 - {p.footer_zone} AND ({_zone(p.footer)} OR (page > 1 AND top > 1 - 1.5 * {p.footer_zone})) THEN 'FOOTER'
  WHEN page <= 4 AND {_zone(p.boilerplate)} THEN 'OTHER' WHEN {_TOCL} >= {p.toc_lines} THEN 'TOC' WHEN kind = 'SECTION' AND {_HEAD} THEN 'SECTION' {_REST}"""


@query(
    f"""WITH b AS (SELECT row_nr, profile, page, type AS kind, {_T} AS t, CASE type WHEN 'HEADER' THEN 20 WHEN 'FOOTER' THEN 780 ELSE 400 END / 800.0 AS top, CASE type WHEN 'HEADER' THEN 32 WHEN 'FOOTER' THEN 792 ELSE 412 END / 800.0 AS bot FROM segments)
SELECT row_nr, CASE profile WHEN 'etsi-contribution' THEN {_profile_sql(classes.PROFILES[1])} WHEN 'ietf-rfc' THEN {_profile_sql(classes.PROFILES[2])} ELSE {_profile_sql(classes.PROFILES[0])} END AS type FROM b"""
)
def classes_blocks(spark, d):
    return classes.classified_blocks(_blocks(spark, d)).select("row_nr", "type")


_STYLE = "CASE type WHEN 'SECTION' THEN 'Heading 2' WHEN 'TOC' THEN 'TOC 1' WHEN 'INFORM' THEN CASE WHEN page % 2 = 0 THEN 'NO' END WHEN 'NORM' THEN CASE WHEN page % 3 = 0 THEN 'B1+' ELSE 'Normal' END ELSE 'Custom' END"


@query(
    f"""WITH b AS (SELECT row_nr, {_STYLE} AS style, {_T} AS t FROM segments)
SELECT row_nr, CASE WHEN t = '' THEN 'OTHER' WHEN style = 'NO' THEN 'INFORM' WHEN style = 'B1+' THEN 'NORM' WHEN style = 'Heading 2' THEN 'SECTION' WHEN style = 'TOC 1' THEN 'TOC'
  WHEN regexp_matches(lower(t), 'intellectual property|essential patents|important notice|modal verbs terminology|foreword') THEN 'OTHER' WHEN {_TOCL} > 0 THEN 'TOC' {_REST} AS class FROM b"""
)
def classes_paragraphs(spark, d):
    return _rows(spark, d, "type", "page").select("row_nr", classes.paragraph_class(F.expr(_STYLE), F.col("text"), F.lit(0.0)).alias("class"))


@query(f"WITH b AS (SELECT row_nr, source_file, {_STYLE} AS style, text FROM segments WHERE source_file IS NOT NULL) SELECT style, count(*) AS n, style <> 'Custom' AS known, arg_min(text[1:70], (source_file, row_nr)) AS sample FROM b WHERE style IS NOT NULL GROUP BY 1")
def classes_styles(spark, d):
    rows = _rows(spark, d, "type", "page", F.col("source_file").alias("doc")).where("doc IS NOT NULL")
    return classes.style_audit(rows.select("doc", F.col("row_nr").alias("pos"), F.expr(_STYLE).alias("style"), "text"))


@query(
    rf"""WITH p AS (SELECT row_nr, source_file, type, {_T} AS t FROM segments WHERE source_file IS NOT NULL AND text IS NOT NULL),
h AS (SELECT *, CASE WHEN type = 'SECTION' AND {_HEAD} THEN rtrim(regexp_extract(t, '^(\S+)', 1), '.') END AS num, CASE WHEN type = 'SECTION' THEN CASE WHEN {_HEAD} THEN regexp_extract(t, '^\S+\s+(.*)$', 1) ELSE t END END AS title FROM p)
SELECT row_nr, coalesce(last_value(num IGNORE NULLS) OVER w, '') AS section, coalesce(last_value(title IGNORE NULLS) OVER w, '') AS section_title FROM h WINDOW w AS (PARTITION BY source_file ORDER BY row_nr ROWS UNBOUNDED PRECEDING)"""
)
def classes_carried_sections(spark, d):
    rows = _rows(spark, d, "type", F.col("source_file").alias("doc")).where("doc IS NOT NULL AND text IS NOT NULL")
    return classes.carried_sections(rows.withColumn("pos", F.col("row_nr"))).select("row_nr", "section", "section_title")


# ---- merged runs: the same fold as a recursion over the rows of a document

_FOLD = r"""WITH RECURSIVE s AS (SELECT source_file AS doc, row_nr AS pos, type, coalesce(section, '') AS section, coalesce(text, '') AS text, normative_keywords AS kw, row_number() OVER (PARTITION BY source_file ORDER BY row_nr) AS rn FROM segments WHERE source_file IS NOT NULL),
r AS (SELECT doc, rn, pos, type, section, text AS held, 1 AS g, NOT coalesce(type IN ('NORM', 'INFORM'), false) OR (length(text) >= 200 AND regexp_matches(text, '[.;:]\s*$')) AS closed FROM s WHERE rn = 1
UNION ALL SELECT doc, rn, pos, type, section, held, g, NOT coalesce(type IN ('NORM', 'INFORM'), false) OR (length(held) >= 200 AND regexp_matches(held, '[.;:]\s*$')) FROM (
  SELECT s.doc, s.rn, s.pos, s.type, s.section, CASE WHEN j THEN regexp_replace(r.held, '\s+$', '') || ' ' || regexp_replace(s.text, '^\s+|\s+$', '', 'g') ELSE s.text END AS held, r.g + CASE WHEN j THEN 0 ELSE 1 END AS g
  FROM (SELECT r.*, s.rn AS srn, NOT r.closed AND s.type IS NOT DISTINCT FROM r.type AND s.section = r.section AND length(r.held) + 1 + length(s.text) <= 1800 AS j FROM r JOIN s ON s.doc = r.doc AND s.rn = r.rn + 1) r JOIN s ON s.doc = r.doc AND s.rn = r.srn)),
m AS (SELECT doc, g, min(pos) AS pos, arg_max(held, rn) AS held, any_value(type) AS type, any_value(section) AS section, count(*) AS n_merged FROM r GROUP BY 1, 2)
"""


@query(
    _FOLD
    + r"""SELECT m.doc, m.pos, m.type, m.section, regexp_replace(held, '^\s+|\s+$', '', 'g') AS text, CAST(n_merged AS INTEGER) AS n_merged, array_to_string(list_sort(list_distinct(flatten((SELECT list(s.kw) FROM r JOIN s USING (doc, rn) WHERE r.doc = m.doc AND r.g = m.g)))), ',') AS keywords FROM m"""
)
def merge_short_segments(spark, d):
    rows = table(spark, d, "segments").select(F.col("source_file").alias("doc"), F.col("row_nr").alias("pos"), "id", "type", "page", "section", "text", F.col("normative_keywords").alias("keywords")).where("doc IS NOT NULL")
    return merge.merge_short(rows).select("doc", "pos", "type", "section", "text", "n_merged", F.array_join(F.array_sort("keywords"), ",").alias("keywords"))


@query(
    _FOLD
    + """, b AS (SELECT source_file, type, length(text) AS n FROM segments WHERE source_file IS NOT NULL AND text IS NOT NULL AND type IN ('NORM', 'INFORM')), a AS (SELECT doc, length(regexp_replace(held, '^\\s+|\\s+$', '', 'g')) AS n, closed FROM (SELECT m.*, (SELECT closed FROM r WHERE r.doc = m.doc AND r.g = m.g ORDER BY rn DESC LIMIT 1) AS closed FROM m) WHERE type IN ('NORM', 'INFORM'))
SELECT (SELECT count(*) FROM b) AS before_n, (SELECT count(*) FROM a) AS after_n, (SELECT median(n) FROM b) AS before_median, (SELECT median(n) FROM a) AS after_median, round((SELECT avg(CAST(closed AS INT)) FROM a), 6) AS ended_share"""
)
def merge_statistics(spark, d):
    rows = table(spark, d, "segments").select(F.col("source_file").alias("doc"), F.col("row_nr").alias("pos"), "id", "type", "page", "section", "text", F.col("normative_keywords").alias("keywords")).where("doc IS NOT NULL")
    return merge.merge_statistics(rows).withColumn("ended_share", F.round("ended_share", 6))


@query("""WITH RECURSIVE s AS (SELECT source_file AS doc, row_nr AS pos, length(text) AS n, row_number() OVER (PARTITION BY source_file ORDER BY row_nr) AS rn FROM segments WHERE source_file IS NOT NULL AND text IS NOT NULL),
r AS (SELECT doc, pos, rn, 1 AS page, n AS held FROM s WHERE rn = 1 UNION ALL SELECT s.doc, s.pos, s.rn, CASE WHEN held >= 3000 THEN page + 1 ELSE page END, CASE WHEN held >= 3000 THEN n ELSE held + n END FROM r JOIN s ON s.doc = r.doc AND s.rn = r.rn + 1)
SELECT doc, pos, page FROM r""")
def seq_virtual_pages(spark, d):
    from clausemill.operators import sequences

    rows = table(spark, d, "segments").select(F.col("source_file").alias("doc"), F.col("row_nr").alias("pos"), "text").where("doc IS NOT NULL AND text IS NOT NULL")
    return sequences.virtual_pages(rows)


# ---- cuts of pages


@query(r"""WITH g AS (SELECT source_file AS doc, page, text, type, row_number() OVER (PARTITION BY source_file, page ORDER BY row_nr) AS k, sum(CASE WHEN type = 'SECTION' THEN 1 ELSE 0 END) OVER (PARTITION BY source_file, page ORDER BY row_nr) AS far FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL),
l AS (SELECT doc, page, text, 12 * k + 30 * far AS y FROM g), c AS (SELECT l.*, q.gap, CASE WHEN y - lag(y) OVER (PARTITION BY q.gap, doc, page ORDER BY y) > q.gap THEN 1 ELSE 0 END AS new FROM l, (SELECT unnest([8, 20, 40, 60]) AS gap) q),
b AS (SELECT gap, doc, page, block, sum(length(text)) + count(*) - 1 AS n FROM (SELECT *, sum(new) OVER (PARTITION BY gap, doc, page ORDER BY y) AS block FROM c) GROUP BY 1, 2, 3, 4)
SELECT doc, CAST(gap AS INTEGER) AS gap, count(*) AS n, median(n) AS median, round(count(*) FILTER (n < 100) / count(*), 6) AS short_share, count(*) < 5 OR median(n) > 1200 AS collapsed FROM b GROUP BY 1, 2""")
def gate_cuts(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "segments").where("source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL")
    w = Window.partitionBy("source_file", "page").orderBy("row_nr")
    far = F.sum(F.when(F.col("type") == "SECTION", 1).otherwise(0)).over(w)
    top = (12 * F.row_number().over(w) + 30 * far).cast("double")
    glyphs = rows.select(F.col("source_file").alias("doc"), "page", "text", top.alias("top"), top.alias("bottom"), F.lit(0.0).alias("x0"), F.lit(10.0).alias("size"), F.lit("Sans").alias("fontname"))
    quality = blocks.gap_quality(glyphs, [8, 20, 40, 60])
    none = quality.select("doc", F.lit(0).alias("baseline_n")).distinct()
    return blocks.judged(quality, none).select("doc", "gap", "n", "median", F.round("short_share", 6).alias("short_share"), "collapsed")


@query(r"""WITH p AS (SELECT source_file, page, sum(length(text)) AS chars, bool_or(coalesce(section, '') <> '') AS sectioned FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL GROUP BY 1, 2),
g AS (SELECT source_file, count(*) AS pages, avg(CAST(coalesce(chars, 0) < 50 AS INT)) AS blank, avg(coalesce(chars, 0)) AS density, avg(CAST(sectioned AS INT)) AS sectioned FROM p GROUP BY 1),
f AS (SELECT source_file, list_filter([CASE WHEN version IS NULL OR version = 'vX.X.X' THEN 'no version' END, CASE WHEN norm IS NULL OR norm = source_file THEN 'no norm' END, CASE WHEN coalesce(shortname, '') = '' THEN 'no shortname' END, CASE WHEN coalesce(page_count, 0) < 3 THEN 'few pages' END,
  CASE WHEN blank > 0.3 THEN 'blank pages' END, CASE WHEN density < 100 THEN 'little text' END, CASE WHEN sectioned < 0.1 THEN 'few sections' END], lambda x: x IS NOT NULL) AS f FROM spec_docs LEFT JOIN g USING (source_file))
SELECT DISTINCT source_file, array_to_string(f, '; ') AS findings, CASE WHEN list_contains(f, 'few pages') THEN 'error' WHEN len(f) > 0 THEN 'warn' ELSE 'ok' END AS status FROM f""")
def gate_ingest(spark, d):
    pages = table(spark, d, "segments").select("source_file", "page", "text", "section")
    return profiles.ingest_findings(table(spark, d, "spec_docs"), pages)


@query(r"""WITH p AS (SELECT source_file, page, sum(length(text)) AS chars, bool_or(coalesce(section, '') <> '') AS sectioned FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL GROUP BY 1, 2),
g AS (SELECT source_file, avg(CAST(coalesce(chars, 0) < 50 AS INT)) AS blank, avg(coalesce(chars, 0)) AS density, avg(CAST(sectioned AS INT)) AS sectioned FROM p GROUP BY 1),
x AS (SELECT DISTINCT source_file, coalesce(page_count, 0) < 3 AS err, version IS NULL OR version = 'vX.X.X' OR norm IS NULL OR norm = source_file OR coalesce(shortname, '') = '' OR coalesce(blank > 0.3 OR density < 100 OR sectioned < 0.1, false) AS wrn, version IS NULL OR version = 'vX.X.X' AS a, norm IS NULL OR norm = source_file AS b, coalesce(shortname, '') = '' AS c, coalesce(blank > 0.3, false) AS d, coalesce(density < 100, false) AS e, coalesce(sectioned < 0.1, false) AS f FROM spec_docs LEFT JOIN g USING (source_file))
SELECT count(*) FILTER (NOT err AND NOT wrn) AS ok, count(*) FILTER (wrn AND NOT err) AS warn, count(*) FILTER (err) AS error, count(*) FILTER (c) AS no_shortname FROM x""")
def gate_ingest_summary(spark, d):
    pages = table(spark, d, "segments").select("source_file", "page", "text", "section")
    return profiles.ingest_summary(profiles.ingest_findings(table(spark, d, "spec_docs"), pages))
