"""Queries of tables of contents and of the sections they describe, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.operators import contents
from clausemill.plans.session import table
from clausemill.queries_core import register

QUERIES, SQL = {}, {}
query = register(QUERIES, SQL)


def _pages(spark, d):
    rows = table(spark, d, "segments").where("source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL")
    return rows.select(F.col("source_file").alias("doc"), "page", F.col("row_nr").alias("at"), "text")


def _lines(spark, d):
    return contents.page_lines(_pages(spark, d))


_LN = r"""ln AS (SELECT doc, page, row_nr, k, CASE WHEN contains(l, '...') OR regexp_matches(l, '[. ][. ][. ][. ]') THEN l ELSE regexp_replace(l, '   +', '  ', 'g') END AS line
  FROM (SELECT doc, page, row_nr, k, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS l FROM (SELECT source_file AS doc, page, row_nr, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k
  FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL)) WHERE l <> ''),
"""
_LEAD, _LOOSE = r"^([A-Z]?\.?[0-9]+(?:\.[0-9]+)*)\.?\s{1,6}(\S.*?)[.\s]{3,}([0-9]{1,4})$", r"^([A-Z]?\.?[0-9]+(?:\.[0-9]+)*)\.?\s{2,}(\S.*?)\s{2,}([0-9]{1,4})$"
_ANN, _USUAL = r"(?i)^annex\s+([a-z])\s*\((?:normative|informative)\)[:\s]*(.*?)[.\s]*([0-9]{1,4})$", r"(?i)^(intellectual property rights|foreword|introduction|history|modal verbs terminology)[.\s]{3,}([0-9]{1,4})$"
_EN = (
    _LN
    + rf"""en AS (SELECT *, CASE WHEN regexp_matches(line, '{_LEAD}') AND length(regexp_extract(line, '{_LEAD}', 2)) BETWEEN 2 AND 80 THEN 'leader' WHEN regexp_matches(line, '{_ANN}') AND NOT regexp_matches(line, '[0-9]{{5}}$') THEN 'annex' WHEN regexp_matches(line, '{_USUAL}') THEN 'unnumbered'
  WHEN regexp_matches(line, '{_LOOSE}') AND length(regexp_extract(line, '{_LOOSE}', 2)) BETWEEN 2 AND 60 THEN 'loose' END AS form FROM ln),
el AS (SELECT doc, page, row_nr, k, form, CASE form WHEN 'leader' THEN regexp_extract(line, '{_LEAD}', 1) WHEN 'annex' THEN 'Annex ' || upper(regexp_extract(line, '{_ANN}', 1)) WHEN 'loose' THEN regexp_extract(line, '{_LOOSE}', 1) ELSE '' END AS num,
  CASE form WHEN 'leader' THEN regexp_extract(line, '{_LEAD}', 2) WHEN 'annex' THEN regexp_extract(line, '{_ANN}', 2) WHEN 'loose' THEN regexp_extract(line, '{_LOOSE}', 2) ELSE regexp_extract(line, '{_USUAL}', 1) END AS title,
  CAST(regexp_extract(line, '([0-9]+)$', 1) AS INT) AS to_page FROM en WHERE form IS NOT NULL),
pe AS (SELECT doc, page, count(form) AS n_entries FROM en GROUP BY 1, 2),
fi AS (SELECT doc, min(page) AS first FROM pe WHERE n_entries >= 3 GROUP BY 1),
tp AS (SELECT pe.doc, pe.page, n_entries FROM pe JOIN fi USING (doc) WHERE page >= first AND NOT EXISTS (SELECT 1 FROM pe z WHERE z.doc = pe.doc AND z.page >= first AND z.page <= pe.page AND z.n_entries = 0))
"""
)


@query(f"WITH {_EN} SELECT row_nr, CAST(k + 1 AS INTEGER) AS pos, num, title, to_page, form FROM el")
def contents_entries(spark, d):
    return contents.entries(_lines(spark, d)).select(F.col("pos.at").alias("row_nr"), (F.col("pos.k") + 1).alias("pos"), "num", "title", "to_page", "form")


@query(f"WITH {_EN} SELECT doc, page, n_entries FROM tp")
def contents_pages(spark, d):
    return contents.contents_pages(_lines(spark, d))


@query(f"WITH {_EN} SELECT CAST(regexp_matches(line, '[ ][0-9]{{1,4}}$') AS BOOLEAN) AS trailing_number, contains(line, '...') OR regexp_matches(line, '[. ][. ][. ][. ]') AS leader, form, count(*) AS n FROM en GROUP BY ALL")
def contents_line_flags(spark, d):
    return contents.line_flags(_lines(spark, d)).groupBy("trailing_number", "leader", "form").agg(F.count("*").alias("n"))


_ST = (
    _EN
    + r""", d AS (SELECT doc, count(DISTINCT page) AS total_pages FROM ln GROUP BY 1), t AS (SELECT doc, sum(n_entries) AS n_entries, list(page ORDER BY page) AS toc_pages FROM tp GROUP BY 1),
a AS (SELECT d.*, t.n_entries, t.toc_pages, coalesce(list_max(toc_pages) + 1, 4) AS after FROM d LEFT JOIN t USING (doc)),
b AS (SELECT doc, min((page, row_nr, k)) AS start FROM ln JOIN a USING (doc) WHERE page >= after AND regexp_matches(lower(line), '^1\.?\s+scope\b') GROUP BY 1),
u AS (SELECT doc, lower(line) AS heading, min((page, row_nr, k)) AS at_ FROM ln JOIN a USING (doc) WHERE page >= after AND lower(line) IN ('intellectual property rights', 'foreword', 'modal verbs terminology', 'introduction') GROUP BY 1, 2),
w AS (SELECT doc, string_agg(heading, ',' ORDER BY at_) AS between_ FROM u LEFT JOIN b USING (doc) WHERE start IS NULL OR at_ < start GROUP BY 1),
p1 AS (SELECT doc, min(page) AS page FROM ln GROUP BY 1), cv AS (SELECT doc, arg_min(line, (row_nr, k)) FILTER (NOT regexp_matches(line, '^(ETSI|Draft|Final|V[0-9]|(EN|TS|TR)\s)')) AS cover_title FROM ln JOIN p1 USING (doc, page) GROUP BY 1)
"""
)


@query(f"WITH {_ST} SELECT doc, total_pages, CAST(coalesce(n_entries, 0) AS BIGINT) AS n_entries, array_to_string(toc_pages, ',') AS toc_pages, start[1] AS body_start, between_ AS between, cover_title FROM a LEFT JOIN b USING (doc) LEFT JOIN w USING (doc) LEFT JOIN cv USING (doc)")
def contents_structure(spark, d):
    s = contents.structure(_lines(spark, d))
    return s.select("doc", "total_pages", "n_entries", F.array_join("toc_pages", ",").alias("toc_pages"), "body_start", F.array_join("between", ",").alias("between"), "cover_title")


@query(f"WITH {_ST} SELECT start[1] AS body_start, count(*) AS documents FROM b GROUP BY 1")
def contents_body_starts(spark, d):
    return contents.start_histogram(contents.structure(_lines(spark, d)))


_SEC = (
    _EN
    + r""", pg AS (SELECT source_file AS doc, page, string_agg(text, chr(10) ORDER BY row_nr) AS text FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2),
lp AS (SELECT doc, max(page) AS last_page FROM pg GROUP BY 1), ow AS (SELECT doc, num, min((to_page, title)) AS m FROM el JOIN tp USING (doc, page) WHERE num <> '' GROUP BY 1, 2),
rg AS (SELECT doc || '#' || num AS id, doc, num, m[2] AS title, m[1] AS page_from, greatest(m[1], coalesce(lead(m[1]) OVER w - 1, last_page)) AS page_to, lag(doc || '#' || num) OVER w AS prev_id FROM ow JOIN lp USING (doc) WINDOW w AS (PARTITION BY doc ORDER BY m[1], num)),
tx AS (SELECT id, regexp_replace(string_agg(text, chr(12) ORDER BY pg.page), '([^.!?:\n])\f([a-z])', '\1 \2', 'g') AS text, sum(length(text)) AS chars FROM rg JOIN pg ON pg.doc = rg.doc AND pg.page BETWEEN page_from AND page_to GROUP BY 1)
"""
)


@query(f"WITH {_SEC} SELECT id, num, title, page_from, page_to, prev_id, md5(coalesce(text, '')) AS text_hash, CAST(coalesce(chars, 0) AS BIGINT) AS chars_in_pages FROM rg LEFT JOIN tx USING (id)")
def contents_sections(spark, d):
    lines = contents.parsed(_lines(spark, d))
    listed = contents.entries(lines).join(contents.contents_pages(lines).select("doc", "page"), ["doc", "page"], "left_semi").where("num <> ''")
    pages = _pages(spark, d).groupBy("doc", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda p: p["text"]), "\n").alias("text"))
    return contents.sections(listed, pages).select("id", "num", "title", "page_from", "page_to", "prev_id", F.md5("text").alias("text_hash"), "chars_in_pages")
