"""Lexical, vector and hybrid search over segments, and the lookups around them.

The index is a set of tables: postings with positions, document lengths, and corpus totals. `stored_index` writes them once,
postings in the order of their terms, so that the files a query doesn't ask for are skipped by their least and largest
terms, for prefixes as well. Ranking is BM25 with all terms required; ties are broken by id, so results are stable.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import normative_keywords
from clausemill.plans.session import materialize

K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
INDEXED, EMBEDDED = ("NORM", "INFORM", "SECTION"), ("NORM", "INFORM")
#: Lower-case letters that decompose into one letter and marks, and that letter; marks of their own are dropped.
_FOLDED = {c: d[0] for c in map(chr, [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)]) if c == c.lower() and len(d := unicodedata.normalize("NFD", c)) > 1 and all(unicodedata.combining(m) for m in d[1:])}
ACCENTED, PLAIN = "".join(_FOLDED), "".join(_FOLDED.values())
#: Postings to a file of a stored index.
FILE_POSTINGS = 2_000_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters or digits, without accents."""
    plain = F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{Mn}+", "")
    return F.regexp_extract_all(plain, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


@dataclass
class Index:
    """postings (term, id, tf, positions), lengths (id, len), totals (n, avg_len)."""

    postings: DataFrame
    lengths: DataFrame
    totals: DataFrame


def build_index(segments: DataFrame) -> Index:
    """The index of segments (id, text), not yet written."""
    words = segments.where(F.col("text").isNotNull()).select("id", tokens(F.col("text")).alias("words"))
    lengths = words.select("id", F.size("words").alias("len"))
    each = words.select("id", F.posexplode("words").alias("pos", "term"))
    postings = each.groupBy("term", "id").agg(F.count("*").alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions"))
    return Index(postings, lengths, lengths.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len")))


def stored_index(segments: DataFrame) -> Index:
    """The index of segments (id, text), written to the shared folder. A term of most texts is spread over several files."""
    built = build_index(segments)
    lengths = materialize(built.lengths, "index-lengths")
    totals = materialize(lengths.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len"), F.coalesce(F.sum("len"), F.lit(0)).alias("words")), "index-totals")
    files = max(1, -(-totals.first()["words"] // FILE_POSTINGS))
    return Index(materialize(built.postings.repartitionByRange(files, "term", "id").sortWithinPartitions("term", "id"), "index-postings"), lengths, totals)


def with_arrivals(index: Index, added: DataFrame, gone: DataFrame) -> Index:
    """The index after segments (id, text) were added and ids (id) taken away: only what is new is tokenized."""
    more = build_index(added)
    keep = lambda df: df.join(gone.select("id").unionByName(added.select("id")).distinct(), "id", "left_anti")
    lengths = keep(index.lengths).unionByName(more.lengths)
    return Index(keep(index.postings).unionByName(more.postings), lengths, lengths.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len")))


@dataclass
class Query:
    """Alternatives (OR) of required terms; phrases are runs of terms; prefixes end in *; excluded terms follow NOT."""

    alternatives: list[list[str]]
    phrases: list[list[str]]
    excluded: list[str]


def parse_query(text: str) -> Query:
    phrases = [re.findall(r"\w+", p.lower()) for p in re.findall(r'"([^"]*)"', text)]
    rest = re.sub(r'"[^"]*"', " ", text)
    excluded = [w.lower() for w in re.findall(r"\bNOT\s+(\w+)", rest)]
    rest = re.sub(r"\bNOT\s+\w+", " ", rest)
    alternatives = [re.findall(r"\w+\*?", a.lower().replace(" and ", " ")) for a in re.split(r"\bOR\b", rest)]
    return Query([a for a in alternatives if a], [p for p in phrases if p], excluded)


def _match(terms: Sequence[str], term: Column | None = None) -> Column:
    term = F.col("term") if term is None else term
    cond = F.lit(False)
    for t in terms:
        cond = cond | (term.startswith(t[:-1]) if t.endswith("*") else term == t)
    return cond


def _slot(terms: Sequence[str]) -> Column:
    """Which of the required terms a posting stands for (a prefix covers many terms)."""
    slot = F.lit(None).cast("string")
    for t in reversed(terms):
        slot = F.when(F.col("term").startswith(t[:-1]) if t.endswith("*") else F.col("term") == t, F.lit(t)).otherwise(slot)
    return slot


def bm25(index: Index, query: str, allowed: DataFrame | None = None) -> DataFrame:
    """(id, score) of the segments that hold one alternative's terms and every phrase, and no excluded term."""
    q = parse_query(query)
    wanted = sorted({t for a in q.alternatives for t in a} | {t for p in q.phrases for t in p})
    hits = index.postings.where(_match(wanted)).withColumn("slot", _slot(wanted))
    df = hits.groupBy("slot").agg(F.count_distinct("id").alias("df"))
    per = hits.groupBy("slot", "id").agg(F.sum("tf").alias("tf"))
    n = index.totals.select("n", "avg_len")
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len"))
    scored = (
        per.join(F.broadcast(df), "slot").join(index.lengths, "id").join(F.broadcast(n))
        .withColumn("part", F.when(idf <= 0, LEAST_IDF).otherwise(idf) * F.col("tf") * (K1 + 1) / norm)
        .groupBy("id").agg(F.sum("part").alias("score"), F.collect_set("slot").alias("slots"))
    )
    has = lambda ts: F.size(F.array_intersect("slots", F.array(*[F.lit(t) for t in sorted(set(ts))]))) == len(set(ts))
    if q.alternatives:
        keep = F.lit(False)
        for a in q.alternatives:
            keep = keep | has(a)
        scored = scored.where(keep)
    for p in q.phrases:
        scored = scored.where(has(p)).join(_phrase(index, p), "id", "left_semi")
    if q.excluded:
        scored = scored.join(index.postings.where(_match(q.excluded)).select("id"), "id", "left_anti")
    if allowed is not None:
        scored = scored.join(allowed.select("id"), "id", "left_semi")
    return scored.select("id", "score")


def _phrase(index: Index, terms: Sequence[str]) -> DataFrame:
    """Ids where the terms follow one another: the starts that all terms agree on."""
    starts = None
    for k, t in enumerate(terms):
        at = index.postings.where(F.col("term") == t).select("id", F.explode("positions").alias("p")).select("id", (F.col("p") - k).alias("start"))
        starts = at if starts is None else starts.join(at, ["id", "start"], "left_semi")
    return starts.select("id")


def top(scored: DataFrame, n: int, by: str = "score") -> DataFrame:
    return scored.orderBy(F.desc(by), "id").limit(n)


def normalized(scored: DataFrame) -> DataFrame:
    """Scores divided by the largest, which is at the top of a bounded result."""
    best = F.max("score").over(Window.partitionBy())
    return scored.select("id", (F.col("score") / F.when(best == 0, 1.0).otherwise(best)).alias("score"))


def vector_scores(vectors: DataFrame, query: Sequence[float], k: int, metric: str = "l2_compat") -> DataFrame:
    """(id, score) of the k nearest of vectors (id, embedding); l2_compat scores 1 - L2/2, cosine the cosine."""
    q = F.array(*[F.lit(float(v)) for v in query])
    dist = F.sqrt(F.aggregate(F.zip_with("embedding", q, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    dot = F.aggregate(F.zip_with("embedding", q, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)) * math.sqrt(sum(v * v for v in query))
    score = 1 - dist / 2 if metric == "l2_compat" else dot / size
    return top(vectors.select("id", score.alias("score")), k)


def knn_join(vectors: DataFrame, queries: DataFrame, k: int, block: int = 1024) -> DataFrame:
    """(query_id, id, rank, distance): the k nearest vectors of each query, the query itself left out.

    Queries are taken in blocks of a bounded number of rows; each block meets all vectors batch by batch as one matrix
    product, every task keeps its own k best a query, and only those are shuffled and ranked.
    """
    out, rest = [], queries.select("id", "embedding")
    blocks = max(1, -(-rest.count() // block))
    for b in range(blocks):
        rows = rest.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        if not rows:
            continue
        sent = vectors.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)))

        def run(batches, sent=sent):
            ids, q = sent.value
            for v in batches:
                if not len(v):
                    continue
                m, own = np.stack(v["embedding"].to_numpy()).astype(np.float64), v["id"].to_numpy()
                d = np.sqrt(np.maximum((q**2).sum(1)[:, None] + (m**2).sum(1)[None] - 2 * q @ m.T, 0))
                d[ids[:, None] == own[None]] = np.inf
                d = np.round(d, 9)
                most = min(k, d.shape[1]) - 1
                # only what can be among the k best is sorted; equal distances at the end are all kept until ids decide
                row, col = np.nonzero(d <= np.partition(d, most, axis=1)[:, most : most + 1])
                o = np.lexsort((own[col], d[row, col], row))
                row, col = row[o], col[o]
                keep = np.arange(row.size) - np.searchsorted(row, row) < k
                row, col = row[keep], col[keep]
                yield pd.DataFrame({"query_id": ids[row], "id": own[col], "distance": d[row, col]})

        out.append(vectors.select("id", "embedding").mapInPandas(run, "query_id long, id long, distance double"))
    merged = vectors.select(F.col("id").cast("bigint").alias("query_id"), F.col("id").cast("bigint").alias("id"), F.lit(0.0).alias("distance")).limit(0)
    for o in out:
        merged = merged.unionByName(o)
    near = F.round("distance", 9)
    w = Window.partitionBy("query_id").orderBy(near, "id")
    return merged.where(F.col("distance") < float("inf")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


#: Vectors that cells are fitted on, cells of an index (a power of two near the root of the rows, at most), rounds of fitting.
SAMPLE_VECTORS, MOST_CELLS, ROUNDS = 50_000, 4096, 10


@dataclass
class VectorIndex:
    """rows (id, embedding, cell) of every vector, a folder for each cell, and the cells' centres."""

    rows: DataFrame
    centres: np.ndarray


def vector_index(vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE_VECTORS) -> VectorIndex:
    """An index of all vectors (id, embedding) by the nearest of some centres.

    The centres are fitted on at most `sample` vectors, the first by a hash of their id; only those reach the driver.
    """
    known = vectors.where("embedding IS NOT NULL").select("id", "embedding")
    n = known.count()
    cells = cells or min(MOST_CELLS, 1 << max(0, round(math.log2(max(1, n)) / 2)))
    order = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    near = order <= int(min(1.0, 2 * sample / max(1, n)) * (1 << 30))
    some = np.array([r[0] for r in known.where(near).orderBy(order, "id").limit(sample).select("embedding").collect()], np.float64)
    if not len(some):
        return VectorIndex(known.withColumn("cell", F.lit(0)), np.zeros((0, 0)))
    centres = some[np.random.default_rng(0).choice(len(some), min(cells, len(some)), replace=False)]
    for _ in range(ROUNDS):
        own = _nearest_cells(some, centres, 1)[:, 0]
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, some)
        centres = np.where(size[:, None] > 0, total / np.maximum(1, size)[:, None], centres)
    sent = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(batches):
        for b in batches:
            if len(b):
                b["cell"] = _nearest_cells(np.stack(b["embedding"].to_numpy()).astype(np.float64), sent.value, 1)[:, 0]
                yield b

    kinds = dict(known.dtypes)
    placed = known.mapInPandas(assign, f"id {kinds['id']}, embedding {kinds['embedding']}, cell int")
    return VectorIndex(materialize(placed, "vector-cells", by="cell"), centres)


def _nearest_cells(m: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    d = (centres**2).sum(1)[None] - 2 * m @ centres.T
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def probes_for(index: VectorIndex, k: int, least: float = 0.92, sample: int = 100) -> int:
    """How many cells must be probed to find the share `least` of the k nearest, measured on the exact neighbours of at most
    `sample` of the indexed vectors. Vectors without clusters need most cells: then the index saves little, and says so."""
    v = index.rows.select("id", "embedding")
    some = v.orderBy(F.xxhash64("id"), "id").limit(sample)
    asked = {r["id"]: r["embedding"] for r in some.collect()}
    if not asked:
        return 1
    cells = knn_join(v, some, k).select("query_id", "id").join(index.rows.select("id", "cell"), "id").select("query_id", "cell").collect()
    order = {i: np.argsort(_nearest_cells(np.array([e], np.float64), index.centres, len(index.centres))[0]) for i, e in asked.items()}
    ranks = np.sort([order[r["query_id"]][r["cell"]] for r in cells])
    return int(ranks[min(len(ranks) - 1, math.ceil(least * len(ranks)) - 1)]) + 1 if len(ranks) else 1


def index_search(index: VectorIndex, queries: DataFrame, k: int, probes: int = 8, block: int = 1024) -> DataFrame:
    """(query_id, id, rank, distance): nearly the k nearest of each query, from the `probes` cells nearest to it.

    A block of queries reads only the folders of its cells, and a vector meets only the queries that probe its cell.
    """
    out, rest = [], queries.where("embedding IS NOT NULL").select("id", "embedding")
    blocks = max(1, -(-rest.count() // block))
    for b in range(blocks if len(index.centres) else 0):
        rows = rest.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        if not rows:
            continue
        q = np.array([r["embedding"] for r in rows], np.float64)
        probed = _nearest_cells(q, index.centres, probes)
        sent = queries.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in rows]), q, probed))

        def run(batches, sent=sent):
            ids, q, probed = sent.value
            for v in batches:
                got = []
                for cell, part in v.groupby("cell"):
                    asks = np.flatnonzero((probed == cell).any(1))
                    m, own = np.stack(part["embedding"].to_numpy()).astype(np.float64), part["id"].to_numpy()
                    d = np.round(np.sqrt(np.maximum((q[asks] ** 2).sum(1)[:, None] + (m**2).sum(1)[None] - 2 * q[asks] @ m.T, 0)), 9)
                    d[ids[asks][:, None] == own[None]] = np.inf
                    most = min(k, d.shape[1]) - 1
                    row, col = np.nonzero(d <= np.partition(d, most, axis=1)[:, most : most + 1])
                    got.append(pd.DataFrame({"query_id": ids[asks][row], "id": own[col], "distance": d[row, col]}))
                if got:
                    yield pd.concat(got)

        wanted = [int(c) for c in np.unique(probed)]
        out.append(index.rows.where(F.col("cell").isin(wanted)).select("id", "embedding", "cell").mapInPandas(run, "query_id long, id long, distance double"))
    merged = queries.select(F.col("id").cast("bigint").alias("query_id"), F.col("id").cast("bigint").alias("id"), F.lit(0.0).alias("distance")).limit(0)
    for o in out:
        merged = merged.unionByName(o)
    w = Window.partitionBy("query_id").orderBy("distance", "id")
    return merged.where(F.col("distance") < float("inf")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hybrid(lexical: DataFrame, vector: DataFrame, limit: int, alpha: float = 0.5) -> DataFrame:
    """(id, bm25, cosine, score) of the union of two bounded candidate lists; a missing side scores 0."""
    a, b = lexical.select("id", F.col("score").alias("bm25")), vector.select("id", F.col("score").alias("cosine"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    both = a.join(b, "id", "full_outer").select("id", zero("bm25").alias("bm25"), zero("cosine").alias("cosine"))
    return top(both.withColumn("score", F.round(alpha * F.col("bm25") + (1 - alpha) * F.col("cosine"), 4)), limit)


def search_norm(segments: DataFrame, index: Index, vectors: DataFrame | None, query: str, embedded: Sequence[float] | None = None, norm: str | None = None, version: str | None = None, limit: int = 10, alpha: float = 0.5, types: Sequence[str] = EMBEDDED) -> DataFrame:
    """Hybrid search with its filters: norm and version before the lexical cut, after the vector cut; types last."""
    limit, alpha = min(max(limit, 1), 20), min(max(alpha, 0.0), 1.0)
    pool = segments
    if norm:
        pool = pool.where(F.lower("norm").contains(norm.lower()))
    if version:
        pool = pool.where(F.col("version") == version)
    none = segments.select("id", F.lit(0.0).alias("score")).limit(0)
    lexical = normalized(top(bm25(index, query, pool), 4 * limit)) if alpha > 0 and query.strip() else none
    near = vector_scores(vectors, embedded, 4 * limit).join(pool.select("id"), "id", "left_semi") if alpha < 1 and vectors is not None and embedded is not None else none
    best = hybrid(lexical, near, 2 * limit, alpha)
    return top(best.join(segments.where(F.col("type").isin(*types)), "id"), limit)


def section_rows(segments: DataFrame, norm: str, section: str = "", version: str | None = None, types: Sequence[str] | None = None) -> DataFrame:
    rows = segments.where(F.lower("norm").contains(norm.lower()))
    if section:
        rows = rows.where((F.col("section") == section) | F.col("section").startswith(section + "."))
    if version:
        rows = rows.where(F.col("version") == version)
    return (rows.where(F.col("type").isin(*types)) if types else rows).orderBy("page", "id")


def get_segment(segments: DataFrame, key: str, id_: object) -> DataFrame:
    """The rows with this key, each with found = true; one row of nulls with found = false if there are none."""
    hit = segments.where(F.col(key) == id_).withColumn("found", F.lit(True))
    asked = segments.sparkSession.range(1).select(F.lit(id_).alias("__asked"))
    return asked.join(hit, F.col("__asked") == F.col(key), "left").drop("__asked").withColumn("found", F.coalesce("found", F.lit(False)))


def totals(catalogue_rows: DataFrame) -> DataFrame:
    """(norms, segments, embedded) of a catalogue."""
    return catalogue_rows.agg(F.count("*").alias("norms"), F.sum("segments").alias("segments"), F.sum("embedded").alias("embedded"))


def reciprocal_ranks(lists: Sequence[DataFrame], limit: int, k: int = 60) -> DataFrame:
    """(id, score): bounded result lists (id, score) fused by the sum of 1 / (k + rank), an alternative to weighted scores."""
    w = Window.orderBy(F.desc("score"), "id")
    ranked = [x.select("id", (1.0 / (k + F.row_number().over(w))).alias("part")) for x in lists]
    both = ranked[0]
    for r in ranked[1:]:
        both = both.unionByName(r)
    return top(both.groupBy("id").agg(F.sum("part").alias("score")), limit)


def citation(norm: Column, version: Column, section: Column) -> Column:
    """How a clause is cited: norm, version, and the clause's number if it has one."""
    clause = F.when(F.coalesce(section, F.lit("")) != "", F.concat(F.lit(", clause "), section)).otherwise("")
    return F.trim(F.concat(norm, F.lit(" "), F.coalesce(version, F.lit("")), clause))


def requirements(segments: DataFrame) -> DataFrame:
    """Normative rows with weight, by the strongest of their modal verbs (3 shall, must and required; 2 should and
    recommended; 1 may and optional), and citation; rows without such a verb are none."""
    verbs = normative_keywords(F.col("text"))
    has = lambda *words: F.exists(verbs, lambda v: v.rlike(f"^({'|'.join(words)})"))
    weight = F.when(has("shall", "must", "required"), 3).when(has("should", "recommended"), 2).when(F.size(verbs) > 0, 1)
    return segments.where("type = 'NORM'").withColumns({"weight": weight, "citation": citation(F.col("norm"), F.col("version"), F.col("section"))}).where("weight IS NOT NULL")


def contents(segments: DataFrame, norm: str, depth: int = 3, version: str | None = None) -> DataFrame:
    rows = section_rows(segments, norm, version=version, types=["SECTION"])
    return rows.where(F.size(F.split("section", r"\.")) <= depth)


def catalogue(segments: DataFrame) -> DataFrame:
    """(norm, version, segments, norm_count, inform_count, section_count, embedded, title) of every standard and version."""
    count = lambda t: F.count_if(F.col("type") == t)
    rolled = segments.groupBy("norm", "version").agg(
        F.count("*").alias("segments"), count("NORM").alias("norm_count"), count("INFORM").alias("inform_count"), count("SECTION").alias("section_count"),
        F.sum("has_embedding").alias("embedded"), F.min_by("text", F.when((F.col("type") == "SECTION") & (F.col("section") == "0"), F.struct("id", "row_nr"))).alias("title"),
    )
    return rolled
