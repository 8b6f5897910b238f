"""Queries of the segment corpus over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.functions import embedding
from clausemill.functions import identifiers as I
from clausemill.functions import text as T
from clausemill.functions import web
from clausemill.operators import graph, incremental, profiles, retrieval, sections, sequences
from clausemill.plans.session import generation, materialize, table
from clausemill.sources import exports

QUERIES, SQL = {}, {}


def register(queries: dict, statements: dict):
    """A decorator that enters a query, and its SQL if there is any, in these tables."""

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql:
                statements[f.__name__] = sql
            return f

        return add

    return query


query = register(QUERIES, SQL)


def _segments(spark, d, *columns):
    return table(spark, d, "segments").select(*columns)


def _indexed(spark, d):
    """Rows of the search index; ids repeat in the source, so a row's number is its key here."""
    rows = _segments(spark, d, F.col("row_nr").alias("id"), "norm", "version", "type", "page", "section", "text")
    return rows.where(F.col("type").isin(*retrieval.INDEXED) & F.col("text").isNotNull())


# ---- identifiers

_FILE = "lower(source_file) || '.pdf'"
_SHORT = r"^([a-z]+)_(\d{3})(\d{3,4})v(\d{2})(\d{2})(\d{2})p\.pdf$"
_LONG = r"^([a-z]+)_(\d{3})(\d{3})(\d{2})v(\d{2})(\d{2})(\d{2})p\.pdf$"
_ARCH = r"^esi-(\d{7})(?:-(\d+))?v(\d{3})(?:v\d{3})?(?:\.(?:pdf|docx))?$"


def _x(p, i, c="f"):
    return f"regexp_extract({c}, '{p}', {i})"


@query(f"""SELECT DISTINCT source_file,
  CASE WHEN regexp_matches(f, '{_SHORT}') THEN upper({_x(_SHORT, 1)}) || ' ' || {_x(_SHORT, 2)} || ' ' || {_x(_SHORT, 3)}
       WHEN regexp_matches(f, '{_LONG}') THEN upper({_x(_LONG, 1)}) || ' ' || {_x(_LONG, 2)} || ' ' || {_x(_LONG, 3)} || ' ' || {_x(_LONG, 4)}
       WHEN regexp_matches(f, '{_ARCH}') THEN CASE WHEN CAST({_x(_ARCH, 1)} AS INT) + 300000 >= 300000 THEN 'EN ' ELSE 'TS ' END
         || CAST((CAST({_x(_ARCH, 1)} AS INT) + 300000) // 1000 AS VARCHAR) || ' ' || lpad(CAST((CAST({_x(_ARCH, 1)} AS INT) + 300000) % 1000 AS VARCHAR), 3, '0')
         || CASE WHEN {_x(_ARCH, 2)} <> '' THEN '-' || {_x(_ARCH, 2)} ELSE '' END
       ELSE regexp_replace(f, '\\.[^.]*$', '') END AS norm,
  CASE WHEN regexp_matches(f, '{_SHORT}') THEN 'v' || CAST({_x(_SHORT, 4)} AS INT) || '.' || CAST({_x(_SHORT, 5)} AS INT) || '.' || CAST({_x(_SHORT, 6)} AS INT)
       WHEN regexp_matches(f, '{_LONG}') THEN 'v' || CAST({_x(_LONG, 5)} AS INT) || '.' || CAST({_x(_LONG, 6)} AS INT) || '.' || CAST({_x(_LONG, 7)} AS INT)
       WHEN regexp_matches(f, '{_ARCH}') THEN 'v' || {_x(_ARCH, 3)}[1] || '.' || {_x(_ARCH, 3)}[2] || '.' || {_x(_ARCH, 3)}[3]
       ELSE 'vX.X.X' END AS version
FROM (SELECT source_file, {_FILE} AS f FROM spec_docs WHERE source_file IS NOT NULL)""")
def ident_file_names(spark, d):
    name = F.concat(F.lower("source_file"), F.lit(".pdf"))
    return table(spark, d, "spec_docs").where("source_file IS NOT NULL").select("source_file", I.file_norm(name).alias("norm"), I.file_version(name).alias("version")).distinct()


@query(r"""SELECT DISTINCT norm, lower(regexp_replace(norm, '[\s_-]+', '', 'g')) AS loose, regexp_replace(regexp_replace(lower(norm), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS stem,
  CASE WHEN regexp_matches(norm, '(?i)(EN|TS|TR|ES|EG|SR)\s*(\d{3})\s*(\d{3})(-\d+)?') THEN upper(regexp_extract(norm, '(?i)(EN|TS|TR|ES|EG|SR)\s*(\d{3})\s*(\d{3})(-\d+)?', 1)) || ' '
    || regexp_extract(norm, '(?i)(EN|TS|TR|ES|EG|SR)\s*(\d{3})\s*(\d{3})(-\d+)?', 2) || ' ' || regexp_extract(norm, '(?i)(EN|TS|TR|ES|EG|SR)\s*(\d{3})\s*(\d{3})(-\d+)?', 3) || regexp_extract(norm, '(?i)(EN|TS|TR|ES|EG|SR)\s*(\d{3})\s*(\d{3})(-\d+)?', 4) END AS ref,
  CASE WHEN regexp_matches(norm, '(?i)\b(EN|TS|TR|ES|EG)\b') THEN upper(regexp_extract(norm, '(?i)\b(EN|TS|TR|ES|EG)\b', 1)) ELSE 'Other' END AS kind
FROM segments WHERE norm IS NOT NULL""")
def ident_keys(spark, d):
    n = F.col("norm")
    return _segments(spark, d, "norm").where("norm IS NOT NULL").distinct().select("norm", I.loose_key(n).alias("loose"), I.safe_stem(n).alias("stem"), I.normalized_ref(n).alias("ref"), I.doc_type(n).alias("kind"))


@query(r"""SELECT source_file, CASE WHEN length(n) = 6 THEN k || ' ' || n[1:3] || ' ' || n[4:6] WHEN length(n) IN (8, 9) THEN k || ' ' || n[1:3] || ' ' || n[4:6] || '-' || CAST(n[7:] AS INT) ELSE source_file END AS doc_ref
FROM (SELECT DISTINCT source_file, upper(regexp_extract(source_file, '^([A-Za-z]+)_', 1)) AS k, regexp_extract(source_file, '^[A-Za-z]+_(\d+)v', 1) AS n FROM spec_docs WHERE source_file IS NOT NULL)""")
def ident_doc_refs(spark, d):
    return table(spark, d, "spec_docs").where("source_file IS NOT NULL").select("source_file").distinct().select("source_file", I.digits_doc_id(F.col("source_file")).alias("doc_ref"))


# ---- text

_KW = r"(?i)\b(shall\s+not|shall|should\s+not|should|must\s+not|must|required|recommended|may\s+not|may|optional)\b"


@query(rf"""SELECT row_nr, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '{_KW}', 1), lambda w: regexp_replace(lower(w), '\s+', ' ', 'g')))), ',') AS keywords
FROM segments WHERE text IS NOT NULL""")
def text_keywords(spark, d):
    return _segments(spark, d, "row_nr", "text").where("text IS NOT NULL").select("row_nr", F.array_join(T.normative_keywords(F.col("text")), ",").alias("keywords"))


@query(r"""SELECT id, num, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '(?i)\b(?:clause|section|annex)\s+([a-z]?[0-9]+(?:[.][0-9]+)*)', 1))), ',') AS refs
FROM toc_segments WHERE text IS NOT NULL""")
def text_cross_references(spark, d):
    return table(spark, d, "toc_segments").where("text IS NOT NULL").select("id", "num", F.array_join(T.cross_references(F.col("text")), ",").alias("refs"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '(?m)[ \t]+$', '', 'g'), '^\s+|\s+$', '', 'g') AS clean
FROM documents WHERE text IS NOT NULL""")
def text_clean(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query(r"""SELECT type, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\b\d{4}-\d{2}-\d{2}\b', '<DATE>', 'g'), '\b\d+\b', '<N>', 'g'), '(?i)v\d+\.\d+\.\d+', '<VER>', 'g'), '\s+', ' ', 'g') AS template, count(*) AS n
FROM segments WHERE text IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def text_templates(spark, d):
    return profiles.template_frequencies(_segments(spark, d, "type", "text"))


@query("SELECT doc_id, md5(text) AS md5, sha1(text)[1:12] AS sha, CAST(length(text) AS INTEGER) AS n, CASE WHEN length(text) > 80 THEN text[1:77] || '...' ELSE text END AS short FROM documents WHERE text IS NOT NULL")
def text_hashes(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(t).alias("md5"), F.left(F.sha1(t), F.lit(12)).alias("sha"), F.length(t).alias("n"), T.shortened(t, 80).alias("short"))


@query(r"""WITH w AS (SELECT s.alias_id, list_distinct(list_filter(string_split(regexp_replace(lower(s.shortname), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')) AS a,
  list_distinct(list_filter(string_split(regexp_replace(lower(c.shortname), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')) AS b FROM norm_aliases s JOIN norm_catalog c USING (norm) WHERE s.shortname IS NOT NULL AND c.shortname IS NOT NULL)
SELECT alias_id, round(len(list_intersect(a, b)) / greatest(len(list_distinct(list_concat(a, b))), 1), 6) AS similarity FROM w""")
def text_title_jaccard(spark, d):
    a = table(spark, d, "norm_aliases").where("shortname IS NOT NULL").select("alias_id", "norm", F.col("shortname").alias("mine"))
    c = table(spark, d, "norm_catalog").where("shortname IS NOT NULL").select("norm", "shortname")
    return a.join(c, "norm").select("alias_id", F.round(T.word_jaccard(F.col("mine"), F.col("shortname")), 6).alias("similarity"))


@query(r"""SELECT doc_id, list_position(list_transform(string_split(text, chr(10)), lambda x: regexp_matches(x, '(?i)escrow\s+agreement')), true) AS first_line FROM documents WHERE regexp_matches(text, '(?i)escrow\s+agreement')""")
def text_regex_search(spark, d):
    hit = table(spark, d, "documents").where(F.col("text").rlike(r"(?i)escrow\s+agreement"))
    return hit.select("doc_id", F.array_position(F.transform(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"(?i)escrow\s+agreement"))), True).cast("int").alias("first_line"))


# ---- segments and sequences


@query("""SELECT norm, arg_max(version, (k, source_file, version)) AS version, arg_max(source_file, (k, source_file, version)) AS source_file FROM (
  SELECT norm, version, source_file, list_transform(regexp_extract_all(version, '[0-9]+'), lambda x: CAST(x AS INT)) AS k FROM spec_docs WHERE norm IS NOT NULL AND regexp_full_match(version, 'v[0-9]+\\.[0-9]+\\.[0-9]+')) GROUP BY norm""")
def seq_latest_versions(spark, d):
    return sequences.latest_versions(table(spark, d, "spec_docs"))


@query("""WITH t AS (SELECT DISTINCT id, string_split(id, '#')[1] AS doc, num, page_from, max(page_to) OVER (PARTITION BY string_split(id, '#')[1]) AS last_page FROM toc_segments WHERE id IS NOT NULL AND page_from IS NOT NULL)
SELECT id, lag(id) OVER w AS prev_id, lead(id) OVER w AS next_id, CASE WHEN contains(num, '.') THEN regexp_replace(num, '\\.[^.]*$', '') END AS parent_num,
  greatest(page_from, coalesce(lead(page_from) OVER w - 1, last_page)) AS page_to FROM t WINDOW w AS (PARTITION BY doc ORDER BY page_from, num)""")
def seq_section_neighbours(spark, d):
    t = table(spark, d, "toc_segments").where("id IS NOT NULL AND page_from IS NOT NULL").select("id", F.split("id", "#")[0].alias("doc"), "num", "page_from", "page_to")
    last = t.groupBy("doc").agg(F.max("page_to").alias("last_page"))
    return sequences.section_neighbours(t.drop("page_to").distinct().join(last, "doc"))


@query("""SELECT row_nr, last_value(nullif(section, '') IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY page, row_nr ROWS UNBOUNDED PRECEDING) AS carried FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL""")
def seq_carried_section(spark, d):
    rows = _segments(spark, d, "row_nr", "source_file", "page", "section").where("source_file IS NOT NULL AND page IS NOT NULL")
    return rows.select("row_nr", sequences.carried(F.col("section"), "source_file", ["page", "row_nr"]).alias("carried"))


@query("""SELECT row_nr, CAST(row_number() OVER (PARTITION BY source_file, page ORDER BY row_nr) AS INTEGER) AS ordinal FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL""")
def seq_ordinals(spark, d):
    from pyspark.sql import Window

    rows = _segments(spark, d, "row_nr", "source_file", "page").where("source_file IS NOT NULL AND page IS NOT NULL")
    return rows.select("row_nr", F.row_number().over(Window.partitionBy("source_file", "page").orderBy("row_nr")).alias("ordinal"))


_POS = "SELECT source_file AS doc, row_nr AS pos, row_nr AS id, type, text FROM segments WHERE source_file IS NOT NULL AND text IS NOT NULL"


def _placed(spark, d):
    return _segments(spark, d, F.col("source_file").alias("doc"), F.col("row_nr").alias("pos"), F.col("row_nr").alias("id"), "type", "text").where("doc IS NOT NULL AND text IS NOT NULL")


@query(rf"""WITH s AS ({_POS}), m AS (SELECT *, CASE WHEN lag(type) OVER w = type AND type IN ('NORM', 'INFORM') AND NOT regexp_matches(rtrim(lag(text) OVER w), '[.!?:]$')
    AND NOT regexp_matches(text, '^\s*(?:[-•*]|\d+[.)]|[a-z]\)|NOTE|EXAMPLE)') THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY doc ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY pos) AS island FROM m)
SELECT doc, CAST(island AS BIGINT) AS island, arg_min(id, pos) AS first_id, count(*) AS n, string_agg(text, ' ' ORDER BY pos) AS text FROM i GROUP BY 1, 2""")
def seq_paragraph_islands(spark, d):
    return sequences.paragraph_islands(_placed(spark, d))


@query(rf"""WITH s AS ({_POS}), n AS (SELECT *, lead(id) OVER w AS next_id, lead(type) OVER w AS next_type FROM s WINDOW w AS (PARTITION BY doc ORDER BY pos))
SELECT id, next_id FROM n WHERE type IN ('NORM', 'INFORM') AND next_type IN ('NORM', 'INFORM') AND length(text) < 400 AND NOT regexp_matches(rtrim(text), '[.!?:;]$')""")
def seq_boundary_candidates(spark, d):
    return sequences.boundary_candidates(_placed(spark, d), 400)


@query("""WITH s AS (SELECT row_nr, norm, row_number() OVER (PARTITION BY norm ORDER BY row_nr) - 1 AS k, greatest(count(*) OVER (PARTITION BY norm) // 5, 1) AS step FROM segments WHERE norm IS NOT NULL)
SELECT row_nr, norm FROM s WHERE k % step = 0 AND k / step < 5""")
def seq_even_sample(spark, d):
    return sequences.even_sample(_segments(spark, d, "row_nr", "norm").where("norm IS NOT NULL"), "norm", "row_nr", 5)


@query("""WITH p AS (SELECT source_file AS doc, page, count(*) AS n_lines FROM segments WHERE source_file IS NOT NULL AND page IS NOT NULL AND type = 'SECTION' GROUP BY 1, 2),
m AS (SELECT *, sum(CASE WHEN n_lines >= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY page) AS run FROM p),
k AS (SELECT *, sum(CASE WHEN n_lines >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc, run ORDER BY page) AS k FROM m),
s AS (SELECT *, coalesce(max(k) OVER (PARTITION BY doc ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 6 AS stuck FROM k)
SELECT doc, page, n_lines >= 3 AND NOT stuck AND k < 6 AS toc_mode FROM s""")
def seq_contents_mode(spark, d):
    rows = _segments(spark, d, F.col("source_file").alias("doc"), "page", "type").where("doc IS NOT NULL AND page IS NOT NULL AND type = 'SECTION'")
    return sequences.contents_mode(rows.groupBy("doc", "page").agg(F.count("*").alias("n_lines")))


# ---- retrieval

_TOKENS = """tok AS (SELECT row_nr AS id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+') AS w FROM segments WHERE type IN ('NORM', 'INFORM', 'SECTION') AND text IS NOT NULL),
len AS (SELECT id, len(w) AS len FROM tok), tot AS (SELECT count(*) AS n, avg(len) AS avg_len FROM len),
post AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM tok) GROUP BY 1, 2)"""


def _bm25_sql(slot: str, n: int, where: str = "true") -> str:
    return f"""{_TOKENS}, hit AS (SELECT id, {slot} AS slot, sum(tf) AS tf FROM post GROUP BY 1, 2 HAVING slot IS NOT NULL), df AS (SELECT slot, count(DISTINCT id) AS df FROM hit GROUP BY 1),
score AS (SELECT id, sum(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS score
  FROM hit JOIN df USING (slot) JOIN len USING (id), tot GROUP BY id HAVING count(*) >= {n}) SELECT id, round(score, 6) AS score FROM score WHERE {where}"""


_stored: dict = {}


def _kept(spark, d, what, make):
    """What is written once for all queries of a session over these tables."""
    key = (spark.sparkContext.applicationId, generation(), d, what)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def _index(spark, d):
    return _kept(spark, d, "index", lambda: retrieval.stored_index(_indexed(spark, d)))


def _vectors(spark, d):
    rows = _indexed(spark, d).where(F.col("type").isin(*retrieval.EMBEDDED)).select("id", embedding.embed("text").alias("embedding"))
    return _kept(spark, d, "vectors", lambda: materialize(rows, "index-vectors"))


def _searched(spark, d, query):
    return retrieval.bm25(_index(spark, d), query)


@query("WITH " + _bm25_sql("CASE WHEN term IN ('escrow', 'agreement', 'ledger') THEN term END", 3))
def search_all_terms(spark, d):
    return _searched(spark, d, "escrow agreement ledger").withColumn("score", F.round("score", 6))


@query("WITH " + _bm25_sql("CASE WHEN term IN ('notarial', 'beacon') THEN term END", 1))
def search_any_term(spark, d):
    return _searched(spark, d, "notarial OR beacon").withColumn("score", F.round("score", 6))


@query("WITH " + _bm25_sql("CASE WHEN starts_with(term, 'custod') THEN 'custod' WHEN term = 'sealed' THEN term END", 2))
def search_prefix(spark, d):
    return _searched(spark, d, "custod* sealed").withColumn("score", F.round("score", 6))


@query("WITH " + _bm25_sql("CASE WHEN term IN ('disputed', 'ballot') THEN term END", 2, "id IN (SELECT id FROM tok WHERE regexp_matches(' ' || array_to_string(w, ' ') || ' ', ' disputed ballot ')) AND id NOT IN (SELECT id FROM post WHERE term = 'escrow')"))
def search_phrase_without(spark, d):
    return _searched(spark, d, '"disputed ballot" NOT escrow').withColumn("score", F.round("score", 6))


@query("""WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 20 = 0),
p AS (SELECT query_id, v.vec_id AS id, round(sqrt(list_sum(list_transform(list_zip(q.e, v.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))), 9) AS dist FROM q JOIN embeddings v ON v.vec_id <> q.query_id)
SELECT query_id, id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS INTEGER) AS rank FROM p) WHERE rank <= 10""")
def search_nearest_vectors(spark, d):
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return retrieval.knn_join(v, v.where("id % 20 = 0"), 10).select("query_id", "id", "rank")


_VEC = """vw AS (SELECT id, term AS w, tf FROM post WHERE false), vr AS (SELECT row_nr AS id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS w FROM segments WHERE type IN ('NORM', 'INFORM') AND text IS NOT NULL UNION ALL SELECT -1, unnest(['escrow', 'ledger'])),
vp AS (SELECT id, 16 * ((strpos('0123456789abcdef', md5(w)[1]) - 1) % 4) + strpos('0123456789abcdef', md5(w)[2]) - 1 AS at_, CASE WHEN md5(w)[3] < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS s FROM vr),
vs AS (SELECT id, at_, sum(s) AS s FROM vp GROUP BY 1, 2), vn AS (SELECT id, sqrt(sum(s * s)) AS n FROM vs GROUP BY 1),
ve AS (SELECT id, list_transform(range(0, 64), lambda k: coalesce(m[k], 0)::FLOAT) AS embedding FROM (SELECT id, map(list(at_), list(s / greatest(n, 1e-12))) AS m FROM vs JOIN vn USING (id) GROUP BY 1))"""


_HYBRID = "WITH " + _bm25_sql("CASE WHEN term IN ('escrow', 'ledger') THEN term END", 2).replace("SELECT id, round(score, 6) AS score FROM score WHERE true", ", " + _VEC + """, qv AS (SELECT embedding AS e FROM ve WHERE id = -1), lx AS (SELECT id, score FROM score ORDER BY score DESC, id LIMIT 40), ln AS (SELECT id, score / max(score) OVER () AS b FROM lx),
vx AS (SELECT id, 1 - sqrt(list_sum(list_transform(list_zip(qv.e, v.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))) / 2 AS c FROM ve v, qv WHERE id >= 0 ORDER BY round(c, 9) DESC, id LIMIT 40),
f AS (SELECT coalesce(ln.id, vx.id) AS id, coalesce(b, 0) AS b, coalesce(c, 0) AS c FROM ln FULL JOIN vx ON ln.id = vx.id)
SELECT id, round(b, 6) AS bm25, round(c, 6) AS cosine, round(0.5 * b + 0.5 * c, 4) AS score FROM f ORDER BY score DESC, id LIMIT 20""")


@query(_HYBRID)
def search_hybrid(spark, d):
    lexical = retrieval.normalized(retrieval.top(_searched(spark, d, "escrow ledger"), 40))
    near = retrieval.vector_scores(_vectors(spark, d), embedding.hashed("escrow ledger").tolist(), 40)
    out = retrieval.hybrid(lexical, near, 20)
    return out.select("id", F.round("bm25", 6).alias("bm25"), F.round("cosine", 6).alias("cosine"), "score")


_SPLIT = _HYBRID.index("SELECT id, round(b, 6) AS bm25")


@query(_HYBRID[:_SPLIT] + "SELECT h.id, score, norm FROM (" + _HYBRID[_SPLIT:] + ") h JOIN segments s ON s.row_nr = h.id WHERE type IN ('NORM', 'INFORM') ORDER BY score DESC, h.id LIMIT 10")
def search_norm_tool(spark, d):
    near = embedding.hashed("escrow ledger").tolist()
    return retrieval.search_norm(_indexed(spark, d), _index(spark, d), _vectors(spark, d), "escrow ledger", near, limit=10).select("id", "score", "norm")


@query("""SELECT row_nr, id, norm, page, text, true AS found FROM segments WHERE id = (SELECT min(id) FROM segments) UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, false""")
def lookup_segment(spark, d):
    rows = _segments(spark, d, "row_nr", "id", "norm", "page", "text")
    first = rows.agg(F.min("id")).first()[0]
    return retrieval.get_segment(rows, "id", first).unionByName(retrieval.get_segment(rows, "id", "no such segment"))


@query("SELECT count(*) AS norms, CAST(sum(n) AS BIGINT) AS segments, CAST(sum(e) AS BIGINT) AS embedded FROM (SELECT norm, version, count(*) AS n, sum(has_embedding) AS e FROM segments GROUP BY ALL)")
def lookup_totals(spark, d):
    return retrieval.totals(retrieval.catalogue(_segments(spark, d, "row_nr", "id", "norm", "version", "type", "section", "text", "has_embedding")))


@query("WITH " + _bm25_sql("CASE WHEN term IN ('notarial', 'beacon') THEN term END", 1).replace("SELECT id, round(score, 6) AS score FROM score WHERE true", """, df2 AS (SELECT term, count(DISTINCT id) AS df FROM post WHERE term IN ('escrow', 'ledger') GROUP BY 1),
s2 AS (SELECT id, sum(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS score FROM post JOIN df2 USING (term) JOIN len USING (id), tot GROUP BY id HAVING count(*) >= 2),
a AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM score), b AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM s2)
SELECT id, round(sum(1.0::DOUBLE / (60 + r)), 6) AS score FROM (SELECT * FROM a WHERE r <= 100 UNION ALL SELECT * FROM b WHERE r <= 100) GROUP BY 1 ORDER BY sum(1.0::DOUBLE / (60 + r)) DESC, id LIMIT 20"""))
def search_fused_ranks(spark, d):
    lists = [retrieval.top(_searched(spark, d, q), 100) for q in ("notarial OR beacon", "escrow ledger")]
    return retrieval.reciprocal_ranks(lists, 20).withColumn("score", F.round("score", 6))


@query("""SELECT norm, version, count(*) AS segments, count(*) FILTER (type = 'NORM') AS norm_count, count(*) FILTER (type = 'INFORM') AS inform_count, count(*) FILTER (type = 'SECTION') AS section_count, CAST(sum(has_embedding) AS BIGINT) AS embedded,
  arg_min(text, (id, row_nr)) FILTER (type = 'SECTION' AND section = '0') AS title FROM segments GROUP BY ALL""")
def lookup_catalogue(spark, d):
    return retrieval.catalogue(_segments(spark, d, "row_nr", "id", "norm", "version", "type", "section", "text", "has_embedding"))


@query("SELECT row_nr, id, norm, version, page, section, text FROM segments WHERE norm ILIKE '%337 792%' AND (section = '5' OR section LIKE '5.%') AND type IN ('NORM', 'INFORM')")
def lookup_section(spark, d):
    rows = retrieval.section_rows(table(spark, d, "segments"), "337 792", "5", types=["NORM", "INFORM"])
    return rows.select("row_nr", "id", "norm", "version", "page", "section", "text")


@query("SELECT row_nr, norm, version, section, text FROM segments WHERE norm ILIKE '%en 388%' AND type = 'SECTION' AND len(string_split(section, '.')) <= 2")
def lookup_contents(spark, d):
    return retrieval.contents(table(spark, d, "segments"), "en 388", 2).select("row_nr", "norm", "version", "section", "text")


# ---- references and the graph

_SPEC = r"(?i)(?:^|[^A-Za-z])((?:EN|TS|TR|ES|EG|SR)\s+\d{3}\s*\d{3}(?:-\d+)?)"


@query(rf"""SELECT DISTINCT doc_id, 'spec' AS source, regexp_replace(regexp_replace(upper(r[1:2]) || r[3:], '\s+', ' ', 'g'), '(\d{{3}}) ?(\d{{3}})', '\1 \2') AS ref FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_SPEC}', 1)) AS r FROM documents WHERE text IS NOT NULL)""")
def graph_citations(spark, d):
    return graph.reference_rows(table(spark, d, "documents").select("doc_id", "text"), "doc_id").where("source = 'spec'")


_EDGES = "e AS (SELECT edge_id, lower(trim(from_id)) AS from_id, lower(trim(to_id)) AS to_id, type, source FROM ref_edges WHERE from_id IS NOT NULL AND to_id IS NOT NULL AND lower(trim(from_id)) <> lower(trim(to_id)))"


def _edges(spark, d):
    return graph.clean_edges(table(spark, d, "ref_edges"))


_DEG = "deg AS (SELECT id, sum(i) AS in_degree, sum(1 - i) AS out_degree FROM (SELECT from_id AS id, 0 AS i FROM e UNION ALL SELECT to_id, 1 FROM e) GROUP BY 1)"


@query(f"WITH {_EDGES}, {_DEG} SELECT id, CAST(in_degree AS BIGINT) AS in_degree, CAST(out_degree AS BIGINT) AS out_degree FROM deg")
def graph_degrees(spark, d):
    return graph.degrees(_edges(spark, d))


@query(f"WITH {_EDGES} SELECT type, source, count(*) AS n, count(DISTINCT to_id) AS targets FROM e GROUP BY 1, 2")
def graph_edge_statistics(spark, d):
    return _edges(spark, d).groupBy("type", "source").agg(F.count("*").alias("n"), F.count_distinct("to_id").alias("targets"))


@query(f"WITH {_EDGES}, {_DEG} SELECT id, CAST(in_degree AS BIGINT) AS in_degree FROM deg WHERE in_degree > 0 ORDER BY in_degree DESC, id LIMIT 15")
def graph_most_cited(spark, d):
    return graph.degrees(_edges(spark, d)).where("in_degree > 0").orderBy(F.desc("in_degree"), "id").limit(15).select("id", "in_degree")


@query(f"""WITH {_EDGES}, h AS (SELECT DISTINCT lower(trim(source_file)) AS id FROM spec_docs WHERE source_file IS NOT NULL), x AS (SELECT from_id AS id FROM e UNION SELECT to_id FROM e)
SELECT id, true AS known FROM h UNION ALL SELECT id, false FROM x WHERE id NOT IN (SELECT id FROM h)""")
def graph_nodes(spark, d):
    return graph.graph_nodes(table(spark, d, "spec_docs"), _edges(spark, d))


@query(f"WITH {_EDGES}, {_DEG}, b AS (SELECT id FROM deg WHERE in_degree > 2 OR out_degree > 2) SELECT edge_id, from_id, to_id FROM e WHERE from_id IN (SELECT id FROM b) AND to_id IN (SELECT id FROM b)")
def graph_busy_subgraph(spark, d):
    return graph.busy_subgraph(_edges(spark, d)).select("edge_id", "from_id", "to_id")


@query(f"""WITH RECURSIVE {_EDGES}, roots AS (SELECT DISTINCT from_id AS id FROM e WHERE starts_with(from_id, 'en_337')),
r AS (SELECT id, 0 AS depth FROM roots UNION SELECT e.to_id, r.depth + 1 FROM r JOIN e ON e.from_id = r.id WHERE r.depth < 3)
SELECT id, min(depth) AS depth FROM r GROUP BY 1""")
def graph_reachable(spark, d):
    e = _edges(spark, d)
    return graph.reachable(e, e.where("from_id LIKE 'en_337%'").select(F.col("from_id").alias("id")).where(F.col("id").startswith("en_337")), 3)


@query(rf"""WITH c AS (SELECT DISTINCT regexp_replace(regexp_replace(upper(r[1:2]) || r[3:], '\s+', ' ', 'g'), '(\d{{3}}) ?(\d{{3}})', '\1 \2') AS ref FROM (SELECT unnest(regexp_extract_all(text, '{_SPEC}', 1)) AS r FROM documents WHERE text IS NOT NULL))
SELECT ref, coalesce((SELECT max('?WKI_ID=' || wki_id) FROM norm_catalog k WHERE k.norm = ref), 'https://www.etsi.org/standards#page=1&search=' || replace(ref, ' ', '+')) AS url FROM c""")
def graph_urls(spark, d):
    cited = graph.reference_rows(table(spark, d, "documents").select("doc_id", "text"), "doc_id").where("source = 'spec'").select("ref", "source").distinct()
    known = table(spark, d, "norm_catalog").groupBy(F.col("norm").alias("ref")).agg(F.max(F.concat(F.lit("?WKI_ID="), "wki_id")).alias("known"))
    return cited.join(known, "ref", "left").select("ref", web.document_url(F.col("ref"), F.col("source"), F.col("known")).alias("url"))


@query(f"WITH {_EDGES}, h AS (SELECT lower(trim(source_file)) AS id, min(title) AS title FROM spec_docs WHERE source_file IS NOT NULL GROUP BY 1), x AS (SELECT from_id AS id FROM e UNION SELECT to_id FROM e) SELECT id, known, title FROM (SELECT id, true AS known, CASE WHEN title <> '' THEN title END AS title FROM h UNION ALL SELECT id, false, NULL FROM x WHERE id NOT IN (SELECT id FROM h))")
def graph_titled_nodes(spark, d):
    docs = table(spark, d, "spec_docs")
    return graph.titled_nodes(graph.graph_nodes(docs, _edges(spark, d)), docs.where("source_file IS NOT NULL").select(F.lower(F.trim("source_file")).alias("id"), "title"))


@query("SELECT source, count(*) AS n, list(id ORDER BY id) AS ids FROM (SELECT DISTINCT lower(trim(source_file)) AS id, source_format AS source FROM spec_docs WHERE source_file IS NOT NULL AND source_format IS NOT NULL) GROUP BY 1")
def graph_nodes_by_source(spark, d):
    docs = table(spark, d, "spec_docs").where("source_file IS NOT NULL AND source_format IS NOT NULL")
    return graph.nodes_by_source(docs.select(F.lower(F.trim("source_file")).alias("id"), F.col("source_format").alias("source")).distinct())


# ---- profiles and gates


@query(r"""SELECT type, n, files, round(avg_len, 6) AS avg_len, round(boilerplate, 6) AS boilerplate, round(cv, 6) AS cv, CASE WHEN boilerplate > 0.8 THEN 'static' WHEN cv > 0.4 THEN 'review' ELSE 'low-variance' END AS verdict FROM (
SELECT type, count(*) AS n, count(DISTINCT source_file) AS files, avg(length(text)) AS avg_len, stddev_samp(length(text)) / greatest(avg(length(text)), 1) AS cv,
  avg(CAST(length(t) < 5 OR ltrim(t, '0123456789') = '' OR ltrim(t, 'IVX') = '' OR starts_with(upper(t), 'ETSI ') OR contains(upper(t), 'DRAFT EN') OR t LIKE 'Table of contents%' OR t LIKE 'Table of Contents%' OR t LIKE 'Copyright%' OR t LIKE 'copyright%' OR (t LIKE '..%' AND regexp_matches(t, '^[.]+ *[0-9]+$')) AS INT)) AS boilerplate
FROM (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM segments) GROUP BY 1)""")
def profile_types(spark, d):
    out = profiles.type_profile(_segments(spark, d, "type", "text", "source_file"))
    return out.select("type", "n", "files", *[F.round(c, 6).alias(c) for c in ("avg_len", "boilerplate", "cv")], "verdict")


@query("SELECT md5(text) AS hash, count(*) AS n, count(DISTINCT source_file) AS files, min(text) AS sample FROM segments WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_file) > 1 ORDER BY n DESC, hash LIMIT 200")
def profile_repeated_texts(spark, d):
    return profiles.repeated_texts(_segments(spark, d, "text", "source_file"))


@query("SELECT norm, version, count(*) AS n FROM spec_docs WHERE norm IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def profile_repeated_ingests(spark, d):
    return profiles.repeated_ingests(table(spark, d, "spec_docs"))


@query("""SELECT type, count(*) AS n, median(length(text)) AS median, CAST(list_sort(list(length(text)))[count(*) // 10 + 1] AS INTEGER) AS p10, CAST(list_sort(list(length(text)))[count(*) * 9 // 10 + 1] AS INTEGER) AS p90, count(*) FILTER (length(text) < 100) AS short
FROM segments WHERE text IS NOT NULL AND type IS NOT NULL GROUP BY 1""")
def profile_lengths(spark, d):
    return profiles.length_quantiles(_segments(spark, d, "type", "text"))


@query("SELECT norm, count(*) AS total, CAST(sum(has_embedding) AS BIGINT) AS embedded, CAST(count(*) - sum(has_embedding) AS BIGINT) AS gap FROM segments WHERE type IN ('NORM', 'INFORM') AND norm IS NOT NULL GROUP BY 1 HAVING count(*) > sum(has_embedding) ORDER BY gap DESC, norm LIMIT 5")
def profile_embedding_gaps(spark, d):
    return profiles.embedding_gaps(_segments(spark, d, "type", "norm", "has_embedding"))


@query("""SELECT source_file, n, round(s / n, 6) AS heading_density, round(c / n, 6) AS section_coverage, round(r / n, 6) AS norm_ratio,
  array_to_string(list_filter([CASE WHEN s = 0 THEN 'no headings' END, CASE WHEN r = 0 THEN 'no requirements' END, CASE WHEN c < 0.5 * n THEN 'few sections' END], lambda x: x IS NOT NULL), '; ') AS warnings
FROM (SELECT source_file, count(*) AS n, count(*) FILTER (type = 'SECTION') AS s, count(*) FILTER (type = 'NORM') AS r, count(*) FILTER (coalesce(section, '') <> '') AS c FROM segments WHERE source_file IS NOT NULL GROUP BY 1)""")
def profile_documents(spark, d):
    return profiles.document_metrics(_segments(spark, d, "source_file", "type", "section"))


@query("""WITH s AS (SELECT count(*) FILTER (text IS NOT NULL) AS n, median(length(text)) AS m, sum(has_embedding) / count(*) AS e FROM segments WHERE type IN ('NORM', 'INFORM'))
SELECT 'segments' AS "check", CAST(n AS DOUBLE) AS value, n >= 1000 AS ok FROM s UNION ALL SELECT 'median length', m, m >= 150 FROM s UNION ALL SELECT 'embedded', round(e, 6), e >= 0.95 FROM s""")
def gate_health(spark, d):
    return profiles.health(_segments(spark, d, "type", "text", "has_embedding"))


# ---- incremental


@query("SELECT DISTINCT source_file FROM spec_docs WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT source_file FROM segments WHERE source_file IS NOT NULL AND has_embedding = 1 AND type = 'INFORM')")
def incremental_unindexed(spark, d):
    docs = table(spark, d, "spec_docs").where("source_file IS NOT NULL").select("source_file").distinct()
    return docs.join(_segments(spark, d, "source_file", "type", "has_embedding").where("has_embedding = 1 AND type = 'INFORM'"), "source_file", "left_anti")


@query("""SELECT source_file, CAST(epoch(TIMESTAMPTZ '2026-06-01 00:00:00+00') AS BIGINT) - CAST(floor(epoch(ingested_at)) AS BIGINT) AS age, CAST(epoch(TIMESTAMPTZ '2026-06-01 00:00:00+00') AS BIGINT) - CAST(floor(epoch(ingested_at)) AS BIGINT) < 28800 AS fresh FROM spec_docs""")
def incremental_freshness(spark, d):
    rows = table(spark, d, "spec_docs").select("source_file", F.col("ingested_at").alias("fetched_at"))
    return incremental.freshness(rows, "2026-06-01 00:00:00").select("source_file", F.col("age").cast("long").alias("age"), "fresh")


@query("""SELECT id, row_nr, norm, version FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST, row_nr DESC) AS r FROM segments WHERE id IS NOT NULL) WHERE r = 1""")
def incremental_upsert(spark, d):
    rows = _segments(spark, d, "id", "row_nr", "norm", "version", "ingested_at").where("id IS NOT NULL")
    late = F.col("ingested_at") >= F.lit("2025-09-01").cast("timestamp")
    old, new = rows.where(~late | late.isNull()), rows.where(late)
    first = incremental.upsert(old.limit(0), old, ["id"], ["ingested_at", "row_nr"])
    return incremental.upsert(first, new, ["id"], ["ingested_at", "row_nr"]).select("id", "row_nr", "norm", "version")


# ---- exports


@query("""SELECT source_file, string_agg(CASE WHEN type = 'SECTION' THEN repeat('=', least(len(string_split(section, '.')), 5) + 1) || ' ' || text WHEN type = 'NORM' THEN '[.normative]' || chr(10) || text
  WHEN type = 'INFORM' THEN '[.informative]' || chr(10) || text ELSE text END || chr(10), chr(10) ORDER BY row_nr) AS body
FROM segments WHERE type NOT IN ('HEADER', 'FOOTER', 'TOC', 'OTHER') AND text IS NOT NULL AND source_file IS NOT NULL GROUP BY 1""")
def export_asciidoc(spark, d):
    return exports.asciidoc(_segments(spark, d, "row_nr", "source_file", "type", "section", "text"))


_KINDS = "kd AS (SELECT lower(trim(source_file)) AS id, max(upper(norm[1:2])) AS kind FROM spec_docs WHERE source_file IS NOT NULL AND norm IS NOT NULL GROUP BY 1)"


def _kinds(spark, d):
    docs = table(spark, d, "spec_docs").where("source_file IS NOT NULL AND norm IS NOT NULL")
    return docs.groupBy(F.lower(F.trim("source_file")).alias("id")).agg(F.max(F.upper(F.left("norm", F.lit(2)))).alias("kind"))


@query(f"""WITH {_EDGES}, {_DEG}, {_KINDS}, bz AS (SELECT id FROM deg WHERE in_degree > 2 OR out_degree > 2)
SELECT 0 AS pos, 'flowchart LR' AS line UNION ALL SELECT pos, line FROM (SELECT DISTINCT 1 AS pos, from_id, to_id, '  ' || translate(from_id, ' -', '__') || '["' || from_id || '"]' || CASE WHEN type = 'normative' THEN ' --> ' ELSE ' -.-> ' END || translate(to_id, ' -', '__') || '["' || to_id || '"]' AS line
  FROM e WHERE from_id IN (SELECT id FROM bz) AND to_id IN (SELECT id FROM bz) ORDER BY from_id, to_id, line LIMIT 100)
UNION ALL SELECT DISTINCT 2, '  class ' || translate(id, ' -', '__') || ' ' || lower(kind) FROM bz JOIN kd USING (id) WHERE kind IN ('EN', 'TS', 'TR')""")
def export_mermaid(spark, d):
    return exports.mermaid(_edges(spark, d), _kinds(spark, d))


@query(f"""WITH {_EDGES}, {_KINDS}, h AS (SELECT DISTINCT lower(trim(source_file)) AS id FROM spec_docs WHERE source_file IS NOT NULL), x AS (SELECT from_id AS id FROM e UNION SELECT to_id FROM e),
nd AS (SELECT id, 2 AS w FROM h UNION ALL SELECT id, 1 FROM x WHERE id NOT IN (SELECT id FROM h))
SELECT 0 AS pos, 'digraph references {{ rankdir=LR; node [shape=box, style=filled];' AS line UNION ALL SELECT 3, '}}'
UNION ALL SELECT 1, '  "' || id || '" [label="' || replace(id, ' ', '\\n') || '", fillcolor="' || coalesce(CASE kind WHEN 'EN' THEN '#4CAF50' WHEN 'TS' THEN '#2196F3' WHEN 'TR' THEN '#FF9800' WHEN 'ES' THEN '#9C27B0' WHEN 'EG' THEN '#795548' WHEN 'SR' THEN '#607D8B' END, '#CCCCCC') || '", penwidth=' || w || '];' FROM nd LEFT JOIN kd USING (id)
UNION ALL SELECT DISTINCT 2, '  "' || from_id || '" -> "' || to_id || '" [style=' || CASE WHEN type = 'normative' THEN 'solid, color="#333333"' ELSE 'dashed, color="#999999"' END || '];' FROM e""")
def export_dot(spark, d):
    e = _edges(spark, d)
    return exports.dot(graph.graph_nodes(table(spark, d, "spec_docs"), e).join(_kinds(spark, d), "id", "left"), e)


@query("""SELECT source_file, CAST(sum(n) AS BIGINT) AS segment_count, '{' || string_agg('"' || type || '":' || n, ',' ORDER BY type) || '}' AS type_counts
FROM (SELECT source_file, type, count(*) AS n FROM segments WHERE source_file IS NOT NULL AND type IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def export_envelopes(spark, d):
    return exports.envelopes(_segments(spark, d, "source_file", "type"))


# ---- sections, coverage and views


_SECT = "sec AS (SELECT DISTINCT id, string_split(id, '#')[1] AS doc, page_from, page_to, text FROM toc_segments WHERE id IS NOT NULL AND page_from IS NOT NULL AND page_to >= page_from)"
_PAGED = "cov AS (SELECT sec.id, count(*) AS n, sum(length(s.text)) AS chars FROM sec JOIN segments s ON s.source_file = sec.doc AND s.page BETWEEN sec.page_from AND sec.page_to GROUP BY 1)"


def _sections(spark, d):
    t = table(spark, d, "toc_segments").where("id IS NOT NULL AND page_from IS NOT NULL AND page_to >= page_from")
    return t.select("id", F.substring_index("id", "#", 1).alias("doc"), "page_from", "page_to", "text").distinct()


@query(f"WITH {_SECT}, {_PAGED} SELECT id, n, CAST(chars AS BIGINT) AS chars FROM cov")
def section_pages(spark, d):
    return sections.pages_in_sections(_sections(spark, d), _segments(spark, d, F.col("source_file").alias("doc"), "page", "text"))


@query(f"""WITH {_SECT}, {_PAGED} SELECT doc, extracted, available, round(extracted / greatest(available, 1), 3) AS ratio, round(extracted / greatest(available, 1), 3) < 0.85 AS low
FROM (SELECT doc, CAST(sum(length(text)) AS BIGINT) AS extracted, CAST(sum(chars) AS BIGINT) AS available FROM sec JOIN cov USING (id) GROUP BY 1)""")
def section_coverage(spark, d):
    own = _sections(spark, d)
    return sections.coverage(sections.pages_in_sections(own, _segments(spark, d, F.col("source_file").alias("doc"), "page", "text")), own)


@query(r"""SELECT id, num, CASE WHEN regexp_matches(title, '(?i)Intellectual Property|Essential patents|Important Notice|Modal verbs terminology|Foreword|Introduction') THEN 'boilerplate' WHEN regexp_matches(num, '^(?i:annex\s+)?[A-Z](\.|$)') THEN 'annex'
  WHEN regexp_matches(title, '(?i)\(informative\)|^NOTE\b|^EXAMPLE\b') THEN 'inform' ELSE 'norm' END AS kind FROM toc_segments""")
def section_classes(spark, d):
    return table(spark, d, "toc_segments").select("id", "num", sections.section_class(F.col("title"), F.col("num")).alias("kind"))


@query("SELECT title, count(*) AS n FROM toc_segments WHERE title IS NOT NULL AND regexp_full_match(num, '\\d+|[A-Z]') GROUP BY 1 ORDER BY n DESC, title LIMIT 40")
def section_title_frequencies(spark, d):
    return sections.title_frequencies(table(spark, d, "toc_segments"))


@query("SELECT page, count(*) AS docs FROM (SELECT string_split(id, '#')[1] AS doc, min(page_from) AS page FROM toc_segments WHERE page_from IS NOT NULL AND id IS NOT NULL GROUP BY 1) GROUP BY 1")
def section_body_starts(spark, d):
    return sections.body_starts(table(spark, d, "toc_segments"))


@query("SELECT type, row_nr FROM (SELECT type, row_nr, row_number() OVER (PARTITION BY type ORDER BY row_nr) AS r FROM (SELECT type, min(row_nr) AS row_nr FROM segments WHERE text IS NOT NULL AND type IS NOT NULL GROUP BY type, text[1:200])) WHERE r <= 3")
def profile_first_samples(spark, d):
    return sections.first_samples(_segments(spark, d, "row_nr", "type", "text"))


@query("SELECT count(*) AS files, median(m) AS median FROM (SELECT source_file, median(length(text)) AS m FROM segments WHERE text IS NOT NULL AND source_file IS NOT NULL AND type IN ('NORM', 'INFORM') GROUP BY 1)")
def profile_file_medians(spark, d):
    return sections.file_medians(_segments(spark, d, "source_file", "type", "text"))


@query("""SELECT CASE WHEN regexp_matches(norm, '(?i)\\b(EN|TS|TR|ES|EG)\\b') THEN upper(regexp_extract(norm, '(?i)\\b(EN|TS|TR|ES|EG)\\b', 1)) ELSE 'Other' END AS kind, strftime(ingested_at, '%Y-%m') AS month, count(*) AS n, count(DISTINCT source_file) AS files FROM spec_docs GROUP BY 1, 2""")
def profile_by_month(spark, d):
    kind = F.coalesce(I.doc_type(F.col("norm")), F.lit("Other"))
    return table(spark, d, "spec_docs").groupBy(kind.alias("kind"), F.date_format("ingested_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_distinct("source_file").alias("files"))


@query("""SELECT source_file FROM spec_docs WHERE source_file IS NOT NULL AND norm IS NOT NULL AND regexp_full_match(version, 'v[0-9]+\\.[0-9]+\\.[0-9]+')
EXCEPT SELECT arg_max(source_file, (k, source_file, version)) FROM (SELECT norm, version, source_file, list_transform(regexp_extract_all(version, '[0-9]+'), lambda x: CAST(x AS INT)) AS k FROM spec_docs WHERE norm IS NOT NULL AND regexp_full_match(version, 'v[0-9]+\\.[0-9]+\\.[0-9]+')) GROUP BY norm""")
def set_superseded_files(spark, d):
    docs = table(spark, d, "spec_docs")
    dated = docs.where(F.col("source_file").isNotNull() & F.col("norm").isNotNull() & I.version_key(F.col("version")).isNotNull())
    return dated.select("source_file").distinct().join(sequences.latest_versions(docs), "source_file", "left_anti")


@query(f"""WITH {_EDGES}, h AS (SELECT DISTINCT lower(trim(source_file)) AS id FROM spec_docs WHERE source_file IS NOT NULL), v AS (SELECT * FROM e WHERE type = 'normative' AND to_id NOT IN (SELECT id FROM h)) SELECT to_id, count(*) AS n, count(DISTINCT from_id) AS documents FROM v GROUP BY 1""")
def graph_dangling(spark, d):
    have = table(spark, d, "spec_docs").where("source_file IS NOT NULL").select(F.lower(F.trim("source_file")).alias("to_id")).distinct()
    lost = _edges(spark, d).where("type = 'normative'").join(have, "to_id", "left_anti")
    return lost.groupBy("to_id").agg(F.count("*").alias("n"), F.count_distinct("from_id").alias("documents"))


@query(f"WITH {_EDGES} SELECT to_id AS id, 'in' AS side, from_id AS other, type FROM e WHERE to_id LIKE 'en_337%' UNION ALL SELECT from_id, 'out', to_id, type FROM e WHERE from_id LIKE 'en_337%'")
def graph_neighbours(spark, d):
    e = _edges(spark, d)
    into = e.where("to_id LIKE 'en_337%'").select(F.col("to_id").alias("id"), F.lit("in").alias("side"), F.col("from_id").alias("other"), "type")
    return into.unionAll(e.where("from_id LIKE 'en_337%'").select("from_id", F.lit("out"), "to_id", "type"))


@query(rf"""SELECT DISTINCT doc_id, ref FROM (SELECT doc_id, regexp_replace(regexp_replace(upper(r[1:2]) || r[3:], '\s+', ' ', 'g'), '(\d{{3}}) ?(\d{{3}})', '\1 \2') AS ref FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_SPEC}', 1)) AS r FROM documents WHERE text IS NOT NULL))
WHERE regexp_replace(ref, '-\d+$', '') IN (SELECT regexp_replace(norm, '-\d+$', '') FROM norm_catalog)""")
def graph_relevant_citations(spark, d):
    base = lambda c: F.regexp_replace(c, r"-\d+$", "").alias("base")
    cited = graph.reference_rows(table(spark, d, "documents").select("doc_id", "text"), "doc_id").where("source = 'spec'")
    return cited.select("doc_id", "ref", base(F.col("ref"))).join(table(spark, d, "norm_catalog").select(base(F.col("norm"))).distinct(), "base", "left_semi").select("doc_id", "ref")


@query("SELECT row_nr, CAST(length(text) AS INTEGER) AS n FROM segments WHERE type IN ('NORM', 'INFORM') AND coalesce(has_embedding, 0) = 0 AND trim(coalesce(text, '')) <> ''")
def incremental_unembedded(spark, d):
    return embedding.missing(_segments(spark, d, "row_nr", "type", "text", "has_embedding")).select("row_nr", F.length("text").alias("n"))


@query("""WITH vr AS (SELECT row_nr, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS w FROM segments WHERE type IN ('NORM', 'INFORM') AND coalesce(has_embedding, 0) = 0 AND trim(coalesce(text, '')) <> ''),
vp AS (SELECT row_nr, 16 * ((strpos('0123456789abcdef', md5(w)[1]) - 1) % 4) + strpos('0123456789abcdef', md5(w)[2]) - 1 AS at_, CASE WHEN md5(w)[3] < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS s FROM vr),
vs AS (SELECT row_nr, at_, sum(s) AS s FROM vp GROUP BY 1, 2), vn AS (SELECT row_nr, sqrt(sum(s * s)) AS n FROM vs GROUP BY 1)
SELECT row_nr, list_transform(range(0, 64), lambda k: coalesce(m[k], 0)::FLOAT) AS embedding FROM (SELECT row_nr, map(list(at_), list(s / greatest(n, 1e-12))) AS m FROM vs JOIN vn USING (row_nr) GROUP BY 1)""")
def incremental_embeddings(spark, d):
    return embedding.embed_missing(_segments(spark, d, "row_nr", "type", "text", "has_embedding"))
