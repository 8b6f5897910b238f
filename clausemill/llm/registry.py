"""The subpackage's queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.llm import canonical, leakage, mixture, nearcopies, personal, pieces, repeated_lines, scanned, survivors
from clausemill.plans.session import table


def p1_found(spark, d):
    rows = table(spark, d, "segments").select("row_nr", "norm", "type", "text", "source_file")
    return repeated_lines.find_repeated_lines(rows).select("row_nr", "line_nr")


def p1_removed(spark, d):
    rows = table(spark, d, "segments").select("row_nr", "norm", "type", "text", "source_file")
    return repeated_lines.remove_repeated_lines(rows).select("row_nr", "text", "n_removed")


def _p2(spark, d):
    return table(spark, d, "segments").select("row_nr", "id", "type", "page", "text"), table(spark, d, "norm_catalog")


def p2_found(spark, d):
    return scanned.scan_damage(*_p2(spark, d))


def p2_text(spark, d):
    return scanned.mended_text(*_p2(spark, d))


def p3_found(spark, d):
    return pieces.split_oversized(table(spark, d, "segments").select("row_nr", "text")).where("piece_nr = 1").select("row_nr")


def p3_pieces(spark, d):
    return pieces.split_oversized(table(spark, d, "segments").select("row_nr", "text"))


def p3_rejoined(spark, d):
    whole = pieces.rejoined(pieces.split_oversized(table(spark, d, "segments").select("row_nr", "text")))
    return whole.select("row_nr", F.md5("text").alias("text_hash"), "in_limits")


def _p4(spark, d):
    return [table(spark, d, t) for t in ("segments", "source_kinds", "norm_catalog", "spec_docs")]


def p4_found(spark, d):
    return survivors.best_fields(*_p4(spark, d))


def p4_records(spark, d):
    return survivors.surviving_records(*_p4(spark, d))


def _p5(spark, d):
    return table(spark, d, "norm_aliases").where("norm IS NULL").select("alias_id", "alias"), table(spark, d, "norm_catalog")


def p5_found(spark, d):
    return canonical.map_to_list(*_p5(spark, d)).select("alias_id", "norm")


def p5_mapping(spark, d):
    return canonical.map_to_list(*_p5(spark, d)).withColumn("similarity", F.round("similarity", 6))


def _p7(spark, d):
    return table(spark, d, "segments").where("type IN ('NORM', 'INFORM')").select("row_nr", "id", "text")


def p7_found(spark, d):
    return nearcopies.near_pairs(_p7(spark, d))


def p7_classes(spark, d):
    return nearcopies.near_classes(_p7(spark, d))


def _p8(spark, d):
    return table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "text")


def p8_found(spark, d):
    return leakage.verbatim_leaks(*_p8(spark, d))


def p8_reparameterised(spark, d):
    return leakage.reparameterised_leaks(*_p8(spark, d))


def p9_mix(spark, d):
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark, d):
    return mixture.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_checks(spark, d):
    return mixture.mix_checks(mixture.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets")))


def p9_shards(spark, d):
    return mixture.shard_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p10_found(spark, d):
    return personal.found_values(table(spark, d, "documents"))


def p10_redacted(spark, d):
    return personal.redacted(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_removed, p2_found, p2_text, p3_found, p3_pieces, p3_rejoined, p4_found, p4_records, p5_found, p5_mapping, p7_found, p7_classes, p8_found, p8_reparameterised, p9_mix, p9_shares, p9_shards, p9_checks, p10_found, p10_redacted)}

_LINES = r"""
WITH l AS (SELECT row_nr, norm, source_file, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_nr
  FROM segments WHERE norm IS NOT NULL AND text IS NOT NULL AND coalesce(type NOT IN ('SECTION', 'TOC'), true)),
k AS (SELECT row_nr, line_nr, norm, source_file, regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS letters FROM l),
f AS (SELECT norm, letters FROM k WHERE length(letters) >= 45 AND source_file IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT source_file) >= 5)
"""
_USABLE = r"""
WITH u AS (SELECT s.id, s.row_nr, s.segmented_at, coalesce(k.trust, 2147483647) AS trust,
    CASE WHEN s.norm IN (SELECT norm FROM norm_catalog WHERE norm IS NOT NULL) THEN s.norm END AS norm,
    CASE WHEN regexp_full_match(s.version, 'v[0-9]+\.[0-9]+\.[0-9]+') THEN s.version END AS version,
    CASE WHEN s.source_file IN (SELECT source_file FROM spec_docs WHERE source_file IS NOT NULL) THEN s.source_file END AS source_file
  FROM segments s LEFT JOIN (SELECT profile, min(trust) AS trust FROM source_kinds GROUP BY 1) k USING (profile) WHERE s.id IS NOT NULL),
g AS (SELECT id, count(*) AS n FROM u GROUP BY 1)
"""


def _best(field: str) -> str:
    return f"coalesce((SELECT value FROM (SELECT id, {field} AS value, row_number() OVER (PARTITION BY id ORDER BY trust, segmented_at DESC NULLS LAST, {field}) AS r FROM u WHERE {field} IS NOT NULL) q WHERE q.id = g.id AND q.r = 1), '') AS {field}"


_NEAR = r"""
WITH w AS (SELECT row_nr, id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM segments WHERE type IN ('NORM', 'INFORM')),
e AS (SELECT row_nr, id, list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS s FROM w WHERE len(w) >= 30),
c AS (SELECT s, min(row_nr) AS c, len(s) AS n FROM e GROUP BY s), m AS (SELECT row_nr, id, c.c FROM e JOIN c USING (s)),
g AS (SELECT c, n, unnest(s) AS g FROM c),
l AS (SELECT a.c AS a, b.c AS b FROM g a JOIN g b ON a.g = b.g AND a.c < b.c AND 2 * least(a.n, b.n) >= greatest(a.n, b.n) GROUP BY 1, 2 HAVING 2 * count(*) >= greatest(any_value(a.n), any_value(b.n)))
"""


_UNITS = ", ".join(f"'{u}'" for u in sorted(leakage.UNITS))


def _templates(name: str, key: str) -> str:
    return rf"""
{name}w AS (SELECT k, list_transform(p, lambda x: lower(regexp_extract(x, '[\p{{L}}\p{{N}}]+$'))) AS l,
    list_transform(p, lambda x, i: i > 1 AND regexp_matches(x, '\p{{Lu}}[\p{{L}}\p{{N}}]*$') AND regexp_matches(x, '^[^\p{{L}}\p{{N}}]*\p{{Lu}}[\p{{L}}\p{{N}}]*$') AND NOT regexp_matches(x, '[.!?:\n]')) AS cap
  FROM (SELECT {key} AS k, regexp_extract_all(text, '[^\p{{L}}\p{{N}}]*[\p{{L}}\p{{N}}]+') AS p FROM {name} WHERE text IS NOT NULL)),
{name}i AS (SELECT *, list_transform(l, lambda x: CASE WHEN regexp_matches(x, '\p{{Nd}}') THEN '<1>' WHEN x IN ({_UNITS}) THEN '<2>' ELSE x END) AS a FROM {name}w),
{name}j AS (SELECT *, list_transform(a, lambda x, i: CASE WHEN cap[i] AND x NOT IN ('<1>', '<2>') THEN '<3>' ELSE x END) AS b FROM {name}i),
{name}x AS (SELECT k, l[i:i + 11] AS l, a[i:i + 11] AS a, b[i:i + 11] AS b FROM (SELECT *, unnest(range(1, len(l) - 10)) AS i FROM {name}j)),
{name}t AS (SELECT DISTINCT k, l, a AS g FROM {name}x UNION SELECT DISTINCT k, l, b FROM {name}x WHERE a <> b AND len(list_filter(b, lambda x: x IN ('<1>', '<2>', '<3>'))) <= {leakage.MOST_SLOTS})"""


SQL = {
    "p8_reparameterised": "WITH "
    + _templates("documents", "doc_id")
    + ", "
    + _templates("eval_items", "item_id")
    + """, h AS (SELECT DISTINCT d.k AS doc_id, e.k AS item_id, d.l AS w, e.l AS v FROM documentst d JOIN eval_itemst e USING (g)),
n AS (SELECT doc_id, item_id, count(*) AS n_template, count(*) FILTER (w = v) AS n_exact FROM h GROUP BY 1, 2),
s AS (SELECT doc_id, item_id, v[i] AS theirs, w[i] AS mine FROM (SELECT *, unnest(range(1, 13)) AS i FROM h)),
bad AS (SELECT DISTINCT doc_id, item_id FROM s WHERE theirs <> mine GROUP BY doc_id, item_id, theirs HAVING count(DISTINCT mine) > 1)
SELECT doc_id, item_id, CAST(n_template AS INTEGER) AS n_template FROM n WHERE n_exact = 0 AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.doc_id = n.doc_id AND bad.item_id = n.item_id)""",
    "p7_found": _NEAR
    + """, k AS (SELECT c AS a, c AS b FROM c UNION ALL SELECT a, b FROM l)
SELECT DISTINCT least(x.row_nr, y.row_nr) AS row_a, greatest(x.row_nr, y.row_nr) AS row_b FROM k JOIN m x ON x.c = a JOIN m y ON y.c = b WHERE (a <> b OR x.row_nr < y.row_nr) AND x.id IS DISTINCT FROM y.id""",
    "p7_classes": _NEAR
    + """SELECT row_nr, m.c AS class_id, n_copies, coalesce(n_links, 0) AS n_links FROM m JOIN (SELECT c, count(*) AS n_copies FROM m GROUP BY 1) k USING (c)
LEFT JOIN (SELECT c, count(*) AS n_links FROM (SELECT a AS c FROM l UNION ALL SELECT b FROM l) GROUP BY 1) d USING (c)""",
    "p1_found": _LINES + "SELECT row_nr, CAST(line_nr AS INTEGER) AS line_nr FROM k JOIN f USING (norm, letters)",
    "p1_removed": _LINES
    + """, gone AS (SELECT row_nr, list(line_nr) AS nrs FROM k JOIN f USING (norm, letters) GROUP BY 1)
SELECT s.row_nr, CASE WHEN nrs IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(nrs, i)), chr(10)) END AS text,
  CAST(coalesce(len(nrs), 0) AS INTEGER) AS n_removed FROM segments s LEFT JOIN gone USING (row_nr)""",
    "p3_rejoined": "SELECT row_nr, md5(text) AS text_hash, true AS in_limits FROM segments WHERE length(text) > 1800",
    "p9_checks": "SELECT DISTINCT lower(trim(source)) AS source, true AS in_caps, true AS near_target FROM mix_targets WHERE source IS NOT NULL",
    "p3_found": "SELECT row_nr FROM segments WHERE length(text) > 1800",
    "p8_found": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
e AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
ew AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM e)),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM d))
SELECT DISTINCT doc_id, item_id FROM dw JOIN ew USING (g)""",
    "p4_found": _USABLE + f"SELECT id, {_best('norm')}, {_best('version')}, {_best('source_file')} FROM g WHERE n > 1",
    "p4_records": _USABLE
    + """SELECT id, row_nr, completeness, n AS n_records FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY completeness DESC, trust, segmented_at DESC NULLS LAST, row_nr) AS r
  FROM (SELECT *, CAST((norm IS NOT NULL)::INT + (version IS NOT NULL)::INT + (source_file IS NOT NULL)::INT AS INTEGER) AS completeness FROM u)) JOIN g USING (id) WHERE r = 1""",
}
