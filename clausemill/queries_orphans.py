"""Problem 6: its queries and their SQL."""

from __future__ import annotations

from clausemill.operators import orphans
from clausemill.plans.session import table


def _tables(spark, d):
    return (
        table(spark, d, "toc_segments").select("id", "parent", "cross_refs", "extracted_at", "deleted_at"),
        table(spark, d, "spec_docs").select("source_file", "ingested_at", "deleted_at"),
        table(spark, d, "ref_edges").select("edge_id", "to_id", "found_at"),
    )


def p6_found(spark, d):
    return orphans.Cascade(*_tables(spark, d)).direct.select("src_table", "src_key", "ref").distinct()


def p6_cascade(spark, d):
    return orphans.orphan_report(*_tables(spark, d))


QUERIES = {"p6_found": p6_found, "p6_cascade": p6_cascade}

_DIRECT = r"""
WITH RECURSIVE toc_refs AS (
  SELECT id AS src_key, extracted_at AS at_ts, CASE WHEN regexp_full_match(r, '([a-z]|[0-9]+)(\.[0-9]+)*')
      THEN coalesce(string_split(lower(trim(id)), '#')[1], '') || '#' || r ELSE r END AS ref
  FROM (SELECT id, extracted_at, lower(trim(u)) AS r FROM (SELECT id, extracted_at, unnest(cross_refs) AS u FROM toc_segments) WHERE u IS NOT NULL)
  WHERE r <> ''),
toc_state AS (SELECT lower(trim(id)) AS ref, min(extracted_at) AS avail, bool_or(deleted_at IS NOT NULL) AS del FROM toc_segments WHERE id IS NOT NULL GROUP BY 1),
doc_state AS (SELECT lower(trim(source_file)) AS ref, min(ingested_at) AS avail, bool_or(deleted_at IS NOT NULL) AS del FROM spec_docs WHERE source_file IS NOT NULL GROUP BY 1),
edge_refs AS (SELECT CAST(edge_id AS VARCHAR) AS src_key, found_at AS at_ts, lower(trim(to_id)) AS ref FROM ref_edges WHERE to_id IS NOT NULL AND trim(to_id) <> ''),
direct AS (
  SELECT DISTINCT 'toc_segments' AS src_table, src_key, r.ref, r.at_ts FROM toc_refs r LEFT JOIN toc_state s USING (ref) WHERE s.del IS NULL OR s.del OR s.avail > r.at_ts
  UNION
  SELECT DISTINCT 'ref_edges', src_key, r.ref, r.at_ts FROM edge_refs r LEFT JOIN doc_state s USING (ref) WHERE s.del IS NULL OR s.del OR s.avail > r.at_ts)
"""

SQL = {
    "p6_found": _DIRECT + "SELECT DISTINCT src_table, src_key, ref FROM direct",
    "p6_cascade": _DIRECT
    + """,
links AS (SELECT child, target, min(at_ts) AS at_ts FROM (
  SELECT src_key AS child, ref AS target, at_ts FROM toc_refs
  UNION ALL SELECT id, lower(trim(parent)), extracted_at FROM toc_segments WHERE parent IS NOT NULL) GROUP BY 1, 2),
hit AS (
  SELECT DISTINCT src_key FROM direct WHERE src_table = 'toc_segments' AND src_key IS NOT NULL
  UNION
  SELECT l.child FROM links l JOIN hit h ON l.target = lower(trim(h.src_key)) WHERE l.child IS NOT NULL),
o AS (SELECT DISTINCT lower(trim(src_key)) AS target FROM hit),
r AS (SELECT src_table, src_key, at_ts, 'direct' AS kind FROM direct
  UNION ALL SELECT 'toc_segments', child, at_ts, 'inherited' FROM links l WHERE target IN (SELECT target FROM o)
    AND NOT EXISTS (SELECT 1 FROM direct d WHERE d.src_table = 'toc_segments' AND d.src_key IS NOT DISTINCT FROM l.child AND d.ref = l.target))
SELECT src_table, strftime(at_ts, '%Y-%m') AS period, kind, count(*) AS refs, count(DISTINCT coalesce(src_key, chr(1))) AS records FROM r GROUP BY 1, 2, 3
""",
}
