"""Queries of names, files, titles, runs and work items, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.functions import identifiers as I
from clausemill.operators import incremental, names, programme, retrieval
from clausemill.plans.session import table
from clausemill.queries_core import register

QUERIES, SQL = {}, {}
query = register(QUERIES, SQL)


# ---- names

_STEM, _NUM = r"(?i)^esi-00([0-9]{5})(?:-([0-9]+))?v", r"(?i)^(?:EN|TS|TR)\s+([0-9]{3})\s+([0-9]{3,4}(?:-[0-9]+)?)$"


@query(rf"""WITH r AS (SELECT DISTINCT s.norm, s.version, s.source_file, c.norm AS number, c.wki_id FROM segments s LEFT JOIN (SELECT norm, max(wki_id) AS wki_id FROM norm_catalog WHERE norm IS NOT NULL GROUP BY 1) c USING (norm) WHERE s.norm IS NOT NULL),
w AS (SELECT norm, number AS alias, 'short' AS t, 0 AS o FROM r UNION ALL SELECT norm, number || ' ' || nullif(version, ''), 'full', 1 FROM r UNION ALL SELECT norm, 'wki:' || wki_id, 'work_item', 2 FROM r
UNION ALL SELECT norm, source_file, 'archive_key', 3 FROM r WHERE regexp_matches(source_file, '{_STEM}') UNION ALL SELECT norm, 'ESI-00' || regexp_extract(source_file, '{_STEM}', 1) || CASE WHEN regexp_extract(source_file, '{_STEM}', 2) <> '' THEN '-' || regexp_extract(source_file, '{_STEM}', 2) ELSE '' END, 'archive_prefix', 4 FROM r WHERE regexp_matches(source_file, '{_STEM}')
UNION ALL SELECT norm, regexp_extract(norm, '{_NUM}', 1) || ' ' || regexp_extract(norm, '{_NUM}', 2), 'short', 5 FROM r WHERE regexp_matches(norm, '{_NUM}') UNION ALL SELECT norm, regexp_extract(norm, '{_NUM}', 1) || regexp_extract(norm, '{_NUM}', 2), 'short', 6 FROM r WHERE regexp_matches(norm, '{_NUM}')
UNION ALL SELECT norm, 'ETSI ' || norm, 'short', 7 FROM r WHERE regexp_matches(norm, '{_NUM}'))
SELECT trim(alias) AS alias, norm, arg_min(t, o) AS alias_type FROM w WHERE alias IS NOT NULL AND trim(alias) <> '' AND trim(alias) <> norm GROUP BY 1, 2""")
def incremental_aliases(spark, d):
    titles = table(spark, d, "norm_catalog").select("norm", F.col("norm").alias("number"), F.col("wki_id").cast("string").alias("wki_id"))
    return names.build_aliases(table(spark, d, "segments").select("norm", "version", "source_file"), titles)


_ASKED = ("337792", "ETSI EN 388 314", "ts 137 437", "164-205", "EN 337 792", "wki:60642", "EN337 792", "no such")


@query("""WITH q AS (SELECT unnest(['337792', 'ETSI EN 388 314', 'ts 137 437', '164-205', 'EN 337 792', 'wki:60642', 'EN337 792', 'no such']) AS asked),
k AS (SELECT *, lower(regexp_replace(asked, '[\\s_-]+', '', 'g')) AS key, lower(asked) AS raw, regexp_replace(lower(asked), '^(etsi|cen|iso/iec|iso|ietf|rfc)\\s+', '') AS bare, regexp_replace(asked, '[^0-9]', '', 'g') AS dig FROM q),
n AS (SELECT DISTINCT norm, lower(norm) AS l, regexp_replace(norm, '[\\s/-]', '', 'g') AS b FROM segments WHERE norm IS NOT NULL),
c AS (SELECT asked, 0 AS way, a.norm FROM k JOIN norm_aliases a ON lower(regexp_replace(a.alias, '[\\s_-]+', '', 'g')) = key WHERE a.norm IS NOT NULL
UNION ALL SELECT asked, CASE WHEN contains(l, raw) THEN 1 WHEN contains(l, bare) THEN 2 WHEN length(dig) IN (6, 7) AND contains(l, dig[1:3] || ' ' || dig[4:6]) THEN 4 WHEN length(dig) >= 5 AND contains(b, dig) THEN 5
  WHEN length(dig) = 6 AND contains(norm, '00' || lpad(CAST(CAST(dig AS INT) - 300000 AS VARCHAR), 5, '0')) THEN 6 END, norm FROM k, n)
SELECT asked, coalesce(arg_min(c.norm, (way, c.norm)) FILTER (way IS NOT NULL), asked) AS norm FROM q LEFT JOIN c USING (asked) GROUP BY asked""")
def lookup_resolved_names(spark, d):
    return names.resolve_names(table(spark, d, "segments").select("norm"), table(spark, d, "norm_aliases").select("alias", "norm"), _ASKED).select("asked", "norm")


_KEY = r"(?i)^ESI-00([0-9]{5})(?:-([0-9]+))?v"


def _archive(c: str) -> str:
    n = f"(CAST(regexp_extract({c}, '{_KEY}', 1) AS INT) + 300000)"
    return f"CASE WHEN regexp_matches({c}, '{_KEY}') THEN CASE WHEN {n} // 1000 >= 300 THEN 'EN ' ELSE 'TS ' END || ({n} // 1000) || ' ' || lpad(CAST({n} % 1000 AS VARCHAR), 3, '0') || CASE WHEN regexp_extract({c}, '{_KEY}', 2) <> '' THEN '-' || regexp_extract({c}, '{_KEY}', 2) ELSE '' END END"


_VER = r"""CASE WHEN regexp_matches(f, '(?i)^ESI-[0-9]{7}(-[0-9]+)?v[0-9]{3}(v[0-9]+){0,2}$') OR regexp_matches(f, '(?i)^ESI-[0-9]{7}(-[0-9]+)?v[0-9]{2}(v[0-9]+){1,2}$') THEN 'v' || array_to_string(string_split(regexp_extract(f, '(?i)^ESI-[0-9]{7}(?:-[0-9]+)?v([0-9]+)', 1), ''), '.')
  WHEN regexp_matches(f, '(?i)^ESI-[0-9]{7}(-[0-9]+)?v[0-9]+(v[0-9]+){0,2}$') THEN 'v' || regexp_extract(f, '(?i)^ESI-[0-9]{7}(?:-[0-9]+)?v([0-9]+)', 1) END"""


@query(f"SELECT DISTINCT f AS source_file, {_archive('f')} AS norm, {_VER} AS version FROM (SELECT source_file AS f FROM spec_docs WHERE source_file IS NOT NULL)")
def ident_archive_keys(spark, d):
    f = F.col("source_file")
    return table(spark, d, "spec_docs").where(f.isNotNull()).select(f, I.archive_key(f).alias("norm"), I.archive_key_version(f).alias("version")).distinct()


@query(r"""SELECT DISTINCT source_file, CASE WHEN regexp_matches(source_file, '(?i)ESI-00[0-9]{5}') THEN 'TS 1' || regexp_extract(source_file, '(?i)ESI-00([0-9]{2})', 1) || ' ' || regexp_extract(source_file, '(?i)ESI-00[0-9]{2}([0-9]{3})', 1)
    || CASE WHEN regexp_extract(source_file, '(?i)ESI-00[0-9]{5}-?([0-9])', 1) <> '' THEN '-' || regexp_extract(source_file, '(?i)ESI-00[0-9]{5}-?([0-9])', 1) ELSE '' END
  WHEN regexp_matches(source_file, '(?i)(TS|TR|EN|ES)_[0-9]{6}') THEN upper(source_file[1:2]) || ' ' || source_file[4:6] || ' ' || source_file[7:9] || CASE WHEN regexp_extract(source_file[10:], '^([0-9]+)', 1) <> '' THEN '-' || CAST(regexp_extract(source_file[10:], '^([0-9]+)', 1) AS INT) ELSE '' END END AS doc_ref
FROM spec_docs WHERE source_file IS NOT NULL""")
def ident_contribution_refs(spark, d):
    f = F.col("source_file")
    return table(spark, d, "spec_docs").where(f.isNotNull()).select(f, I.docx_doc_id(f).alias("doc_ref")).distinct()


@query(f"SELECT source_file, norm, version FROM (SELECT source_file, coalesce({_archive('f')}, f) AS norm, CASE WHEN {_archive('f')} IS NOT NULL AND v = 'vX.X.X' THEN coalesce({_VER}, v) ELSE v END AS version FROM (SELECT source_file, source_file AS f, CASE WHEN source_format = 'docx' THEN 'vX.X.X' ELSE version END AS v FROM spec_docs))")
def incremental_backfilled_keys(spark, d):
    rows = table(spark, d, "spec_docs").select("source_file", F.col("source_file").alias("norm"), F.when(F.col("source_format") == "docx", I.PLACEHOLDER_VERSION).otherwise(F.col("version")).alias("version"))
    return names.backfilled_keys(rows)


@query("""WITH c AS (SELECT norm, version, arg_min(text, (id, row_nr)) FILTER (type = 'SECTION' AND section = '0') AS title FROM segments GROUP BY ALL), e AS (SELECT *, coalesce(regexp_replace(title, '^\\s+|\\s+$', '', 'g'), '') AS t FROM c)
SELECT norm, version, trim(norm || ' ' || coalesce(version, '') || CASE WHEN t <> '' THEN ' — ' || CASE WHEN length(t) > 80 THEN t[1:77] || '...' ELSE t END ELSE '' END) AS display_name FROM e""")
def lookup_display_names(spark, d):
    rows = table(spark, d, "segments").select("row_nr", "id", "norm", "version", "type", "section", "text", "has_embedding")
    return names.display_names(retrieval.catalogue(rows)).select("norm", "version", "display_name")


@query("""WITH k AS (SELECT DISTINCT norm, lower(regexp_replace(norm, '[\\s_-]+', '', 'g')) AS key FROM spec_docs), a AS (SELECT lower(regexp_replace(norm, '[\\s_-]+', '', 'g')) AS key, max(shortname) AS s FROM norm_aliases WHERE norm IS NOT NULL AND shortname <> '' GROUP BY 1),
b AS (SELECT lower(regexp_replace(norm, '[\\s_-]+', '', 'g')) AS key, max(shortname) AS s FROM norm_catalog WHERE norm IS NOT NULL AND shortname <> '' GROUP BY 1)
SELECT norm, coalesce(a.s, b.s, '') AS shortname, CASE WHEN a.s IS NOT NULL THEN 'sidecar' WHEN b.s IS NOT NULL THEN 'static' ELSE '' END AS shortname_source FROM k LEFT JOIN a USING (key) LEFT JOIN b USING (key)""")
def lookup_short_names(spark, d):
    return names.short_names(table(spark, d, "spec_docs").select("norm").distinct(), table(spark, d, "norm_aliases").select("norm", "shortname"), table(spark, d, "norm_catalog").select("norm", "shortname"))


@query("""SELECT source_file, trim(coalesce(norm, '') || CASE WHEN coalesce(version, '') <> '' THEN ' v' || ltrim(version, 'vV') ELSE '' END || CASE WHEN coalesce(title, '') <> '' THEN ' — ' || title[1:70] ELSE '' END) AS line FROM spec_docs""")
def ident_document_lines(spark, d):
    return table(spark, d, "spec_docs").select("source_file", I.document_line(F.col("norm"), F.col("version"), F.col("title")).alias("line"))


# ---- files, runs, titles


@query("""WITH f AS (SELECT DISTINCT source_file || '.pdf' AS name FROM spec_docs WHERE source_file IS NOT NULL), r AS (SELECT name, list_transform(regexp_extract_all(lower(name), '[0-9]+'), lambda x: ltrim(x, '0')) AS runs FROM f),
x AS (SELECT name, unnest(runs) AS key FROM r), q AS (SELECT DISTINCT norm, regexp_replace(norm, '[^0-9]', '', 'g') AS dig FROM norm_catalog WHERE norm IS NOT NULL),
w AS (SELECT norm, 0 AS way, ltrim(dig[1:7], '0') AS key FROM q WHERE length(dig) >= 7 UNION ALL SELECT norm, 1, ltrim(dig[1:6], '0') FROM q WHERE length(dig) >= 6)
SELECT q.norm AS number, arg_min(name, (way, name)) AS path FROM q LEFT JOIN (SELECT norm, way, name FROM w JOIN x USING (key)) USING (norm) GROUP BY 1""")
def files_of_numbers(spark, d):
    files = table(spark, d, "spec_docs").where("source_file IS NOT NULL").select(F.concat("source_file", F.lit(".pdf")).alias("name")).distinct().withColumn("path", F.col("name"))
    return names.files_of_numbers(table(spark, d, "norm_catalog").select(F.col("norm").alias("number")), files)


@query("""WITH f AS (SELECT DISTINCT source_file || '.pdf' AS path, source_file FROM spec_docs WHERE source_file IS NOT NULL), a AS (SELECT source_file, max('s:' || source_file) AS url FROM spec_docs WHERE shortname_source = 'sidecar' GROUP BY 1), b AS (SELECT source_file, max('r:' || title) AS url FROM spec_docs WHERE source_format = 'docx' GROUP BY 1),
i AS (SELECT norm, 'i:' || norm AS url, regexp_replace(norm, '[^0-9]', '', 'g') AS dig FROM norm_catalog WHERE norm IS NOT NULL), k AS (SELECT key, arg_max(url, norm) AS url FROM (SELECT norm, url, unnest([CASE WHEN length(dig) >= 7 THEN dig[1:7] END, CASE WHEN length(dig) >= 6 THEN dig[1:6] END, CASE WHEN length(dig) >= 5 THEN dig[1:5] END]) AS key FROM i) WHERE key IS NOT NULL GROUP BY 1),
p AS (SELECT path, regexp_replace(path, '[^0-9]', '', 'g') AS dig FROM f), m AS (SELECT path, coalesce(k7.url, k6.url, k5.url) AS url FROM p LEFT JOIN k k7 ON length(dig) >= 7 AND k7.key = dig[1:7] LEFT JOIN k k6 ON length(dig) >= 6 AND k6.key = dig[1:6] LEFT JOIN k k5 ON length(dig) >= 5 AND k5.key = dig[1:5])
SELECT path, coalesce(a.url, b.url, m.url) AS url, CASE WHEN a.url IS NOT NULL THEN 'sidecar' WHEN b.url IS NOT NULL THEN 'results' WHEN m.url IS NOT NULL THEN 'item' END AS source FROM f LEFT JOIN a USING (source_file) LEFT JOIN b USING (source_file) LEFT JOIN m USING (path)""")
def files_urls(spark, d):
    docs = table(spark, d, "spec_docs").where("source_file IS NOT NULL").withColumn("path", F.concat("source_file", F.lit(".pdf")))
    items = table(spark, d, "norm_catalog").select(F.col("norm").alias("pos"), F.col("norm").alias("number"), F.concat(F.lit("i:"), "norm").alias("url"))
    return names.urls_of_files(docs.select("path"), docs.where("shortname_source = 'sidecar'").select("path", F.concat(F.lit("s:"), "source_file").alias("url")), docs.where("source_format = 'docx'").select("path", F.concat(F.lit("r:"), "title").alias("url")), items)


@query("""WITH o AS (SELECT norm, max('?WKI_ID=' || wki_id) AS url FROM norm_aliases WHERE norm IS NOT NULL AND wki_id IS NOT NULL GROUP BY 1)
SELECT c.norm AS number, coalesce(CASE WHEN abbr IS NOT NULL THEN NULL ELSE c.wki_id END, o.url[9:], c.wki_id) AS wki_id, CASE WHEN abbr IS NULL AND c.wki_id IS NOT NULL THEN 'recorded' WHEN o.url IS NOT NULL THEN 'overview' WHEN c.wki_id IS NOT NULL THEN 'page' END AS source FROM norm_catalog c LEFT JOIN o USING (norm)""")
def files_repaired_work_items(spark, d):
    c = table(spark, d, "norm_catalog").select(F.col("norm").alias("number"), F.when(F.col("abbr").isNotNull(), "unknown").otherwise(F.col("wki_id")).alias("wki_id"), F.concat(F.lit('<a href="?WKI_ID='), "wki_id", F.lit('">')).alias("html"))
    return names.repaired_work_items(c, table(spark, d, "norm_aliases").select(F.col("norm").alias("number"), F.concat(F.lit("?WKI_ID="), "wki_id").alias("url")))


@query("""WITH s AS (SELECT source_file AS stem, max(ingested_at) AS modified FROM spec_docs WHERE source_file IS NOT NULL GROUP BY 1), o AS (SELECT source_file AS stem, max(segmented_at) AS made FROM segments GROUP BY 1)
SELECT stem FROM s LEFT JOIN o USING (stem) WHERE made IS NULL OR made < modified""")
def incremental_changed_sources(spark, d):
    s = table(spark, d, "spec_docs").where("source_file IS NOT NULL").groupBy(F.col("source_file").alias("stem")).agg(F.max("ingested_at").alias("modified"))
    return incremental.changed_since(s, table(spark, d, "segments").select(F.col("source_file").alias("stem"), F.col("segmented_at").alias("modified"))).select("stem")


_BUCKETS = "CASE WHEN deleted_at IS NOT NULL THEN 'failed' WHEN page_count IS NULL THEN 'noDownload' WHEN source_format = 'docx' THEN 'redownloaded' ELSE 'success' END"


def _results(spark, d):
    return table(spark, d, "spec_docs").select(F.col("source_file").alias("number"), F.expr(_BUCKETS).alias("bucket"))


@query(f"""WITH r AS (SELECT source_file AS number, {_BUCKETS} AS bucket FROM spec_docs), p AS (SELECT source_file AS number FROM spec_docs WHERE shortname_source = 'sidecar')
SELECT 'count:' || bucket AS kind, NULL AS number, count(*) AS n FROM r GROUP BY bucket UNION ALL SELECT DISTINCT 'problem', number, 1 FROM r WHERE bucket IN ('failed', 'noDownload') UNION ALL SELECT DISTINCT 'regression', number, 1 FROM r WHERE bucket = 'failed' AND number IN (SELECT number FROM p)""")
def incremental_history(spark, d):
    before = table(spark, d, "spec_docs").where("shortname_source = 'sidecar'").select(F.col("source_file").alias("number"), F.lit("success").alias("bucket"))
    return incremental.history_entry(_results(spark, d), before, "2026-06-01 00:00:00").drop("at")


@query(f"""SELECT number, arg_max(path, (o, path)) AS path, arg_max(bucket, (o, path)) AS bucket FROM (SELECT source_file AS number, norm AS path, {_BUCKETS} AS bucket, CASE {_BUCKETS} WHEN 'success' THEN 0 WHEN 'redownloaded' THEN 1 ELSE 2 END AS o FROM spec_docs WHERE source_file IS NOT NULL AND norm IS NOT NULL) WHERE bucket <> 'noDownload' GROUP BY 1""")
def incremental_results_index(spark, d):
    r = table(spark, d, "spec_docs").where("norm IS NOT NULL").select(F.col("source_file").alias("number"), F.col("norm").alias("path"), F.expr(_BUCKETS).alias("bucket"))
    of = lambda b: r.where(F.col("bucket") == b).drop("bucket")
    return incremental.results_index(of("success"), of("redownloaded"), of("failed")).withColumn("bucket", F.when(F.col("bucket") == "skipped", "failed").otherwise(F.col("bucket")))


@query("""WITH t AS (SELECT upper(regexp_replace(norm, '[\\s-]', '', 'g')) AS key, any_value(abbr) AS st, any_value(title) AS ft FROM norm_catalog WHERE norm IS NOT NULL GROUP BY 1)
SELECT source_file, norm, shortname, coalesce(nullif(shortname_source, ''), CASE WHEN nullif(shortname, '') IS NOT NULL THEN 'static' ELSE '' END) AS shortname_source, coalesce(nullif(st, ''), profile) AS short_title, coalesce(nullif(title, ''), ft) AS full_title, st AS own_short_title FROM spec_docs LEFT JOIN t ON key = upper(regexp_replace(norm, '[\\s-]', '', 'g'))""")
def incremental_patched_titles(spark, d):
    docs = table(spark, d, "spec_docs").select("source_file", "norm", "shortname", "shortname_source", F.col("profile").alias("short_title"), F.col("title").alias("full_title"), F.lit("").alias("own_short_title"))
    titles = table(spark, d, "norm_catalog").select(F.col("norm").alias("number"), F.col("abbr").alias("short_title"), F.col("title").alias("full_title"), F.col("abbr").alias("own_short_title"))
    return incremental.patched_titles(docs, titles)


@query("""WITH k AS (SELECT lower(regexp_replace(norm, '[\\s_-]', '', 'g')) AS key, title, deleted_at FROM spec_docs)
SELECT norm AS number FROM norm_catalog WHERE norm IS NOT NULL AND lower(regexp_replace(norm, '[\\s_-]', '', 'g')) NOT IN (SELECT key FROM k WHERE key IS NOT NULL AND title <> '' AND NOT regexp_matches(title, '(?i)^(title\\s*[0-9]+\\s*)+$'))
AND lower(regexp_replace(norm, '[\\s_-]', '', 'g')) NOT IN (SELECT key FROM k WHERE key IS NOT NULL AND deleted_at IS NOT NULL)""")
def incremental_to_enrich(spark, d):
    docs = table(spark, d, "spec_docs")
    return incremental.to_enrich(table(spark, d, "norm_catalog").where("norm IS NOT NULL").select(F.col("norm").alias("number")), docs.select(F.col("norm").alias("number"), F.col("title").alias("full_title")), docs.where("deleted_at IS NOT NULL").select(F.col("norm").alias("number")))


@query("SELECT norm, arg_min(source_file, (ingested_at, source_file)) AS source_file FROM spec_docs WHERE norm IS NOT NULL AND source_file IS NOT NULL AND ingested_at IS NOT NULL GROUP BY 1")
def set_first_occurrences(spark, d):
    rows = table(spark, d, "spec_docs").where("norm IS NOT NULL AND source_file IS NOT NULL AND ingested_at IS NOT NULL").select("norm", "source_file", F.struct("ingested_at", "source_file").alias("at"))
    return incremental.first_occurrences(rows, "norm", "at").drop("at")


@query("""WITH x AS (SELECT source_file, count(*) FILTER (type IN ('NORM', 'INFORM') AND trim(text) <> '') AS n_expected FROM segments WHERE source_file IS NOT NULL GROUP BY 1),
i AS (SELECT source_file, count(*) AS n_rows, count(*) FILTER (type IN ('NORM', 'INFORM')) AS n_text, count(*) FILTER (has_embedding = 1) AS n_embedded FROM segments WHERE source_file IS NOT NULL AND type IN ('NORM', 'INFORM', 'SECTION') GROUP BY 1), m AS (SELECT DISTINCT source_file FROM spec_docs)
SELECT source_file, source_file IN (SELECT source_file FROM m WHERE source_file IS NOT NULL) AS in_meta, coalesce(n_rows, 0) AS n_rows, coalesce(n_text, 0) AS n_text, n_expected, coalesce(n_embedded, 0) AS n_embedded,
  source_file IN (SELECT source_file FROM m WHERE source_file IS NOT NULL) AND coalesce(n_rows, 0) > 0 AND coalesce(n_text, 0) >= n_expected AND coalesce(n_text, 0) > 0 AND n_embedded >= 0.95 * n_text AS ok FROM x LEFT JOIN i USING (source_file)""")
def gate_index(spark, d):
    rows = table(spark, d, "segments").select("source_file", "type", "text", "has_embedding").where("source_file IS NOT NULL")
    expected = rows.groupBy("source_file").agg(F.count_if(F.col("type").isin("NORM", "INFORM") & (F.trim("text") != "")).alias("n_expected"))
    return incremental.index_check(expected, rows.where(F.col("type").isin(*retrieval.INDEXED)), table(spark, d, "spec_docs"))


@query("""SELECT norm, type, count(*) AS n, CAST(sum(coalesce(has_embedding, 0)) AS BIGINT) AS embedded, CASE GROUPING(norm, type) WHEN 0 THEN 'type' WHEN 1 THEN 'norm' ELSE 'total' END AS level FROM segments GROUP BY ROLLUP (norm, type)""")
def profile_index(spark, d):
    return incremental.index_statistics(table(spark, d, "segments").select("norm", "type", "has_embedding"))


# ---- work items: orders stand for them, a customer's number for the standard's

_RULES = (("early", r"urgent|high"), ("late", r"low"))
_ITEMS = """it AS (SELECT o_orderkey AS pos, 'EN ' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS number, o_orderkey AS work_item_id, CASE o_orderstatus WHEN 'O' THEN 'Drafting' WHEN 'F' THEN 'Published' ELSE 'On approval' END AS stage, o_orderpriority AS title, CAST(o_orderdate AS DATE) AS status_date, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) + 200 END AS next_date FROM orders),
cur AS (SELECT *, upper(number[1:2]) AS kind, contains(stage, 'Drafting') OR contains(stage, 'approval') AS active FROM it QUALIFY row_number() OVER (PARTITION BY number ORDER BY work_item_id DESC, pos) = 1)"""


def _items(spark, d):
    o = table(spark, d, "orders")
    stage = F.when(F.col("o_orderstatus") == "O", "Drafting").when(F.col("o_orderstatus") == "F", "Published").otherwise("On approval")
    day = F.to_date("o_orderdate")
    rows = o.select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("EN "), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("number"), F.col("o_orderkey").alias("work_item_id"), stage.alias("stage"), F.col("o_orderpriority").alias("title"), day.alias("status_date"), F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(day, 200)).alias("next_date"))
    return programme.current_items(rows).withColumns({"kind": I.doc_type(F.col("number")), "active": programme.is_active(F.col("stage"), ("Drafting", "approval"))})


@query(f"WITH {_ITEMS} SELECT number, work_item_id, stage, active FROM cur")
def programme_current(spark, d):
    return _items(spark, d).select("number", "work_item_id", "stage", "active")


@query(f"WITH {_ITEMS} SELECT 'kind' AS dimension, kind AS value, count(*) AS n FROM cur GROUP BY kind UNION ALL SELECT 'stage', stage, count(*) FROM cur GROUP BY stage")
def programme_counts(spark, d):
    return programme.counts(_items(spark, d))


@query(f"WITH {_ITEMS} SELECT kind, count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS published, count(*) AS total FROM cur GROUP BY 1")
def programme_split(spark, d):
    return programme.split_counts(_items(spark, d))


@query(f"WITH {_ITEMS} SELECT strftime(next_date, '%Y-%m') AS month, CAST(row_number() OVER (PARTITION BY strftime(next_date, '%Y-%m') ORDER BY next_date, number) AS INTEGER) AS at, number, next_date FROM cur WHERE active AND next_date BETWEEN DATE '2000-01-01' AND DATE '2000-01-01' + 180")
def programme_upcoming(spark, d):
    return programme.upcoming(_items(spark, d), "2000-01-01")


@query(f"WITH {_ITEMS} SELECT number, rank FROM (SELECT number, CAST(row_number() OVER (ORDER BY coalesce(next_date, status_date) NULLS LAST, number) AS INTEGER) AS rank FROM cur WHERE active) WHERE rank <= 50")
def programme_due_first(spark, d):
    from pyspark.sql import Window

    top = programme.by_due_date(_items(spark, d)).limit(50)
    return top.select("number", F.row_number().over(Window.orderBy(F.coalesce("next_date", "status_date").asc_nulls_last(), "number")).alias("rank"))


@query(f"""WITH {_ITEMS}, c AS (SELECT *, CASE WHEN regexp_matches(lower(number || ' ' || title), 'urgent|high') THEN 'early' WHEN contains(lower(number || ' ' || title), 'low') THEN 'late' ELSE 'Other' END AS cat FROM cur)
SELECT '1 active' AS part, '| ' || number || ' | ' || title || ' | ' || stage || ' | ' || status_date || ' | ' || coalesce(CAST(next_date AS VARCHAR), '-') || ' |' AS line FROM c WHERE active
UNION ALL SELECT '2 category ' || cat, '| ' || number || ' | ' || title || ' | ' || stage || ' | ' || coalesce(CAST(next_date AS VARCHAR), '-') || ' |' FROM c WHERE active UNION ALL SELECT '3 published ' || kind, '| ' || number || ' | ' || title || ' | ' || status_date || ' |' FROM c WHERE NOT active
UNION ALL SELECT '4 due ' || strftime(next_date, '%Y-%m'), '| ' || next_date || ' | ' || number || ' | ' || title || ' |' FROM c WHERE active AND next_date BETWEEN DATE '2000-01-01' AND DATE '2000-01-01' + 180""")
def programme_report(spark, d):
    return programme.report_lines(_items(spark, d), "2000-01-01", _RULES).select("part", "line")
