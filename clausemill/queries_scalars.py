"""Queries of scalar functions, fetch decisions, views and small folds, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.functions import text as T
from clausemill.functions import web
from clausemill.operators import graph, incremental, retrieval, sequences
from clausemill.plans.session import table
from clausemill.queries_core import _EDGES, _edges, register

QUERIES, SQL = {}, {}
query = register(QUERIES, SQL)


@query(r"""SELECT row_nr, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_extract(x, '^([A-Z]?\.?(?:[0-9]+\.)+[0-9]*|\.?[0-9]+)\s+[A-Z].{2,80}$', 1)), lambda x: x <> ''), ',') AS numbers FROM segments WHERE text IS NOT NULL AND type IN ('SECTION', 'OTHER')""")
def text_headings(spark, d):
    rows = table(spark, d, "segments").where("text IS NOT NULL AND type IN ('SECTION', 'OTHER')")
    return rows.select("row_nr", F.array_join(T.headings(F.col("text")), ",").alias("numbers"))


@query(r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE regexp_matches(text, '(?i)escrow')), a AS (SELECT *, list_position(list_transform(l, lambda x: regexp_matches(x, '(?i)escrow')), true) AS k FROM l)
SELECT doc_id, array_to_string(list_transform(l, lambda x, i: CASE WHEN i = k THEN '>>> ' || x ELSE x END)[greatest(k - 1, 1):k + 1], chr(10)) AS snippet FROM a""")
def text_snippets(spark, d):
    rows = table(spark, d, "documents").where(F.col("text").rlike("(?i)escrow"))
    return rows.select("doc_id", T.snippet(F.col("text"), "escrow").alias("snippet"))


@query(r"""SELECT norm, array_to_string(list_transform(regexp_extract_all(title, '[A-Za-z]+|[^A-Za-z]+'), lambda x: CASE WHEN length(x) < 4 THEN regexp_replace(x, '([A-Za-z])', '\1\1', 'g') ELSE x END), '') AS mended, true AS suspect FROM norm_catalog WHERE title IS NOT NULL""")
def text_undoubled(spark, d):
    twice = F.regexp_replace("title", "([A-Za-z])", "$1$1")
    return table(spark, d, "norm_catalog").where("title IS NOT NULL").select("norm", T.undouble(twice).alias("mended"), (T.doubled_ratio(twice) > 0.05).alias("suspect"))


@query(r"""SELECT norm, '| norm | title |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || norm || ' | ' || replace(title, '|', '\|') || ' |' AS markdown FROM norm_catalog WHERE norm IS NOT NULL AND title IS NOT NULL""")
def text_tables(spark, d):
    rows = F.array(F.array(F.lit("norm"), F.lit("title")), F.array("norm", "title", F.lit("cut")), F.array(F.lit(""), F.lit(None).cast("string")))
    return table(spark, d, "norm_catalog").where("norm IS NOT NULL AND title IS NOT NULL").select("norm", T.table_markdown(rows).alias("markdown"))


@query(r"""WITH p AS (SELECT source_file AS doc, page, string_agg(text, chr(10) ORDER BY row_nr) AS text FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2)
SELECT doc, md5(regexp_replace(string_agg(text, chr(12) ORDER BY page), '([^.!?:\n])\f([a-z])', '\1 \2', 'g')) AS text_hash FROM p GROUP BY 1""")
def text_stitched(spark, d):
    rows = table(spark, d, "segments").where("source_file IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL")
    listed = lambda at: F.transform(F.sort_array(F.collect_list(F.struct(at, "text"))), lambda x: x["text"])
    pages = rows.groupBy(F.col("source_file").alias("doc"), "page").agg(F.array_join(listed("row_nr"), "\n").alias("text"))
    return pages.groupBy("doc").agg(F.md5(T.stitched(listed("page"))).alias("text_hash"))


@query(r"""SELECT norm, wki_id AS item, 'https://h.example/deliver/x.asp?WKI_ID=' || wki_id AS clean, 'delivery' AS kind, regexp_replace(regexp_replace(title, '[^A-Za-z0-9._-]+', '_', 'g'), '_{2,}', '_', 'g') AS name, printf('%.1f KB', round(CAST(wki_id AS BIGINT) / 1024::DOUBLE, 1)) AS size,
  'https://h.example/deliver/x.asp?WKI_ID=' || wki_id AS absolute FROM norm_catalog WHERE wki_id IS NOT NULL AND title IS NOT NULL""")
def web_scalars(spark, d):
    c = table(spark, d, "norm_catalog").where("wki_id IS NOT NULL AND title IS NOT NULL")
    path = F.concat(F.lit("/deliver/x.asp?a=&WKI_ID="), F.col("wki_id").cast("string"))
    url = F.concat(F.lit("https://h.example"), path)
    return c.select("norm", web.work_item_id(url).alias("item"), web.clean_url(url).alias("clean"), web.url_class(url).alias("kind"), web.safe_name(F.col("title")).alias("name"), web.size_text(F.col("wki_id").cast("bigint")).alias("size"), web.absolute_url(path, "https://h.example").alias("absolute"))


_STATE = "CASE WHEN shortname IS NULL THEN 'unknown' WHEN source_format = 'docx' THEN 'changed' ELSE 'same' END"


@query(f"""SELECT source_file, CASE WHEN page_count IS NULL THEN 'download' WHEN deleted_at IS NOT NULL THEN 'download' WHEN profile = 'etsi-spec' AND {_STATE} = 'changed' THEN 'report-changed' WHEN profile = 'etsi-spec' THEN 'skip' WHEN shortname_source = 'sidecar' THEN 'skip' WHEN {_STATE} = 'same' THEN 'refresh' ELSE 'download' END AS action,
  CASE WHEN page_count * 1000 >= 20000 THEN 'docx' WHEN page_count > 0 THEN 'pdf' ELSE 'unknown' END AS format FROM spec_docs""")
def fetch_actions(spark, d):
    no = F.lit(False)
    action = web.fetch_action(F.col("page_count").isNotNull(), F.col("deleted_at").isNotNull(), F.coalesce(F.col("profile") == "etsi-spec", no), F.coalesce(F.col("shortname_source") == "sidecar", no), F.expr(_STATE))
    return table(spark, d, "spec_docs").select("source_file", action.alias("action"), web.format_choice(F.col("page_count") * 1000, F.col("page_count")).alias("format"))


@query("""WITH n AS (SELECT source_file AS url, max(version) AS e, max(page_count) AS l FROM spec_docs WHERE source_file IS NOT NULL GROUP BY 1), o AS (SELECT source_file AS url, min(version) AS e, min(page_count) AS l FROM spec_docs WHERE source_file IS NOT NULL AND shortname_source = 'sidecar' GROUP BY 1)
SELECT url, CASE WHEN coalesce(n.e = o.e, n.l = o.l) IS NULL THEN 'unknown' WHEN coalesce(n.e = o.e, n.l = o.l) THEN 'same' ELSE 'changed' END AS state FROM n LEFT JOIN o USING (url)""")
def incremental_change_states(spark, d):
    docs = table(spark, d, "spec_docs").where("source_file IS NOT NULL")
    now = docs.groupBy(F.col("source_file").alias("url")).agg(F.max("version").alias("etag"), F.max("page_count").alias("length"))
    seen = docs.where("shortname_source = 'sidecar'").groupBy(F.col("source_file").alias("url")).agg(F.min("version").alias("etag"), F.min("page_count").alias("length"))
    return incremental.change_state(seen, now)


@query("SELECT source_file AS path, md5(coalesce(title, '')) AS crc FROM spec_docs WHERE source_file IS NOT NULL AND (source_file, md5(coalesce(title, ''))) NOT IN (SELECT source_file, md5(coalesce(title, '')) FROM spec_docs WHERE source_file IS NOT NULL AND shortname_source = 'sidecar')")
def incremental_pending(spark, d):
    files = table(spark, d, "spec_docs").where("source_file IS NOT NULL").select(F.col("source_file").alias("path"), F.md5(F.coalesce("title", F.lit(""))).alias("crc"), "shortname_source")
    return incremental.pending(files.drop("shortname_source"), files.where("shortname_source = 'sidecar'"))


@query("SELECT norm, min(norm) AS first FROM (SELECT norm FROM norm_catalog WHERE norm IS NOT NULL UNION SELECT norm FROM spec_docs WHERE norm IS NOT NULL) GROUP BY 1")
def incremental_inserted(spark, d):
    one = lambda t: table(spark, d, t).where("norm IS NOT NULL").select("norm", F.col("norm").alias("first"))
    return incremental.insert_missing(one("norm_catalog"), one("spec_docs"), "norm")


@query(f"""WITH {_EDGES}, h AS (SELECT DISTINCT lower(trim(source_file)) AS id FROM spec_docs WHERE source_file IS NOT NULL), v AS (SELECT * FROM e WHERE type = 'normative' AND from_id IN (SELECT id FROM h) AND to_id IN (SELECT id FROM h))
SELECT id, 'node' AS part, NULL AS edge_id FROM (SELECT from_id AS id FROM v UNION SELECT to_id FROM v) UNION ALL SELECT from_id, 'edge', edge_id FROM v""")
def graph_view(spark, d):
    nodes, edges = graph.visible(graph.graph_nodes(table(spark, d, "spec_docs"), _edges(spark, d)), _edges(spark, d), ("normative",), stubs=False)
    return nodes.select("id", F.lit("node").alias("part"), F.lit(None).cast("bigint").alias("edge_id")).unionByName(edges.select(F.col("from_id").alias("id"), F.lit("edge").alias("part"), "edge_id"))


@query(r"""SELECT norm, list_sort([norm, 'RFC 3161']) AS normative, ['RFC 5280'] AS informative, CAST(3 AS INTEGER) AS total FROM norm_catalog WHERE regexp_full_match(norm, '(EN|TS|TR|ES|EG|SR) [0-9]{3} [0-9]{3}(-[0-9]+)?')""")
def graph_reference_sections(spark, d):
    text = F.concat(F.lit("1 Scope\nSee RFC 9999.\nNormative references\n"), "norm", F.lit(", RFC 3161\nInformative references\nRFC 3161 and RFC 5280\n3 Terms"))
    docs = table(spark, d, "norm_catalog").where(F.col("norm").rlike(r"^(EN|TS|TR|ES|EG|SR) \d{3} \d{3}(-\d+)?$")).select("norm", text.alias("text"))
    s = graph.section_references(docs, "norm")
    return s.join(graph.reference_counts(s, "norm").select("norm", "total"), "norm").select("norm", F.array_sort("normative").alias("normative"), "informative", "total")


@query("""WITH t AS (SELECT source_file AS doc, row_nr AS pos, page FROM segments WHERE type = 'TABLE' AND source_file IS NOT NULL AND page IS NOT NULL), g AS (SELECT *, CASE WHEN lag(page) OVER w = page - 1 THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY doc ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY pos) AS island FROM g) SELECT doc, min(page) AS first_page, count(*) AS pages, CAST(count(*) + 1 AS INTEGER) AS n_rows FROM i GROUP BY doc, island""")
def seq_merged_tables(spark, d):
    t = table(spark, d, "segments").where("type = 'TABLE' AND source_file IS NOT NULL AND page IS NOT NULL")
    rows = F.array(F.array(F.lit("key"), F.lit("value")), F.array(F.col("row_nr").cast("string"), F.lit("x")))
    placed = t.select(F.col("source_file").alias("doc"), F.col("row_nr").alias("pos"), "page", F.lit(0.1).alias("top"), F.lit(0.9).alias("bottom"), rows.alias("rows"))
    return sequences.merged_tables(placed).select("doc", "first_page", "pages", F.size("rows").alias("n_rows"))


@query("""SELECT o_custkey AS doc, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus = 'F') AS last_done, array_to_string(coalesce(list(o_orderpriority ORDER BY o_orderkey) FILTER (o_orderstatus <> 'F'), [])[1:3], ',') AS pending FROM orders GROUP BY 1""")
def seq_milestones(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("achieved"))
    return sequences.milestone_state(o).select("doc", "last_done", F.array_join("pending", ",").alias("pending"))


@query(r"""SELECT row_nr, norm, section, CASE WHEN k LIKE '%shall%' OR k LIKE '%must%' OR k LIKE '%required%' THEN 3 WHEN k LIKE '%should%' OR k LIKE '%recommended%' THEN 2 ELSE 1 END AS weight, trim(norm || ' ' || coalesce(version, '') || CASE WHEN coalesce(section, '') <> '' THEN ', clause ' || section ELSE '' END) AS citation
FROM (SELECT *, array_to_string(list_transform(regexp_extract_all(text, '(?i)\b(shall|should|must|required|recommended|may|optional)\b', 1), lambda w: lower(w)), ',') AS k FROM segments WHERE type = 'NORM' AND norm IS NOT NULL) WHERE k <> ''""")
def lookup_requirements(spark, d):
    return retrieval.requirements(table(spark, d, "segments").where("norm IS NOT NULL")).select("row_nr", "norm", "section", "weight", "citation")


@query("SELECT CAST(10 AS INTEGER) AS k, count(*) AS queries, true AS recall_reached FROM embeddings WHERE vec_id % 20 = 0")
def search_vector_index(spark, d):
    """How the index does against the exact search: its recall at 10 is to be 0.9 at least."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    asked = v.where("id % 20 = 0")
    index = retrieval.vector_index(v)
    found = retrieval.index_search(index, asked, 10, retrieval.probes_for(index, 10))
    both = retrieval.knn_join(v, asked, 10).select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return both.agg(F.lit(10).alias("k"), F.count_distinct("query_id").alias("queries"), (F.count("hit") >= 0.9 * F.count("*")).alias("recall_reached"))


@query(r"""WITH c AS (SELECT norm, wki_id FROM norm_catalog WHERE norm IS NOT NULL AND wki_id IS NOT NULL)
SELECT norm, unnest(['ietf', 'ietf', 'iso', 'itu', 'w3c', 'openid', 'openid']) AS source, unnest(['RFC ' || wki_id[1:4], 'SD-JWT VC', 'ISO ' || wki_id || '-5', 'ITU-T X' || wki_id[1:3], 'W3C VC-' || wki_id, 'OpenID4VCI', 'HAIP']) AS ref FROM c""")
def graph_bodies(spark, d):
    w = F.col("wki_id").cast("string")
    text = F.concat(F.lit("See RFC "), F.left(w, F.lit(4)), F.lit(", SD-JWT VC; ISO/IEC "), w, F.lit("–5 and ITU-T X."), F.left(w, F.lit(3)), F.lit("; W3C Recommendation, W3C VC-"), w, F.lit("; OpenID4VCI or HAIP"))
    docs = table(spark, d, "norm_catalog").where("norm IS NOT NULL AND wki_id IS NOT NULL").select("norm", text.alias("text"))
    return graph.reference_rows(docs, "norm")
