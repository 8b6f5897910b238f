import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clausemill.operators import blocks, classes, graph, incremental, merge, orphans, profiles, retrieval, sequences

S53 = "A sentence of about fifty characters without an end xx"


@pytest.mark.parametrize(
    ("rows", "ids"),
    [
        (["a:", "b:"], "a"), (["a:5.1", "b:5.1"], "a"), (["a:", "b:5.1"], "a b"), (["a:5.1", "b:5.2"], "a b"), (["a:5.1/NORM", "b:5.1/INFORM"], "a b"),
        (["a:5", "h:5.1/SECTION", "c:5.1"], "a h c"), (["a:", "b:", "c:"], "a"), (["p1:", "p2:", "s1:5.1", "s2:5.1", "t:5.2"], "p1 s1 t"),
    ],
)
def test_merging_of_short_segments(spark, rows, ids):
    parsed = [(k.split(":")[0], *(k.split(":")[1].split("/") + ["NORM"])[:2]) for k in rows]
    df = spark.createDataFrame([("d", i, k, t, 1, s, S53, ["shall"]) for i, (k, s, t) in enumerate(parsed)], "doc string, pos int, id string, type string, page int, section string, text string, keywords array<string>")
    out = merge.merge_short(df).orderBy("pos").collect()
    assert " ".join(r.id for r in out) == ids and sum(r.n_merged for r in out) == len(rows)


def test_merging_stops_at_the_limit_and_at_a_full_sentence(spark):
    rows = [("d", 0, "a", "NORM", 1, "5", "x" * 1790, None), ("d", 1, "b", "NORM", 1, "5", "y" * 20, []), ("e", 0, "c", "NORM", 1, "", "z" * 200 + ".", []), ("e", 1, "f", "NORM", 1, None, "next", [])]
    df = spark.createDataFrame(rows, "doc string, pos int, id string, type string, page int, section string, text string, keywords array<string>")
    assert sorted(r.id for r in merge.merge_short(df).collect()) == ["a", "b", "c", "f"]
    assert merge.merge_short(df.limit(0)).count() == 0


TOC = "id string, parent string, cross_refs array<string>, extracted_at timestamp, deleted_at timestamp, ref string, reason string"
DOCS = "source_file string, ingested_at timestamp, deleted_at timestamp"
EDGES = "edge_id long, to_id string, found_at timestamp, src_key string"
T = [datetime(2024, m, 1) for m in range(1, 7)]


def orphan_tables(spark, toc, docs, edges):
    return (
        spark.createDataFrame([(*r, None, None) for r in toc], TOC), spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*r, None) for r in edges], EDGES),
    )


def test_orphans_direct_and_inherited(spark):
    toc = [
        ("d1#1", None, ["2", " D1#9 ", None, ""], T[1], None), ("d1#2", "d1#1", ["d1#3"], T[1], None), ("d1#3", None, ["d1#4"], T[1], None),
        ("d1#4", None, None, T[3], None), ("d1#5", None, ["d1#6"], T[1], None), ("d1#6", None, [], T[1], T[2]), ("d1#7", "d1#3", ["D1#4"], T[4], None), (None, None, ["x#1"], T[1], None),
    ]
    toc += toc[:2]
    docs = [("d1", T[1], None), ("D2", T[3], None), ("d3", T[1], T[2]), (None, None, None)]
    edges = [(1, "D1 ", T[2]), (2, "d2", T[2]), (3, "d3", T[2]), (4, "d4", T[2]), (5, None, T[2]), (6, "d2", None)]
    t = orphan_tables(spark, toc, docs, edges)
    got = {(r.src_table, r.src_key, r.ref, r.reason) for r in orphans.direct_orphans(*t).collect()}
    assert got == {
        ("toc_segments", "d1#1", "d1#9", "absent"), ("toc_segments", "d1#3", "d1#4", "late"), ("toc_segments", "d1#5", "d1#6", "deleted"), ("toc_segments", None, "x#1", "absent"),
        ("ref_edges", "2", "d2", "late"), ("ref_edges", "3", "d3", "deleted"), ("ref_edges", "4", "d4", "absent"),
    }
    kinds = {r.src_key: (r.kind, r.round) for r in orphans.orphan_cascade(*t).where("src_table = 'toc_segments'").collect()}
    assert kinds == {"d1#1": ("direct", 0), "d1#3": ("direct", 0), "d1#5": ("direct", 0), "d1#2": ("inherited", 1), "d1#7": ("inherited", 1)}


def test_orphans_of_cycles_and_of_nothing(spark):
    ring = [(f"c#{i}", None, [f"c#{(i + 1) % 20}"], T[1], None) for i in range(20)] + [("c#x", None, ["c#0", "gone#1"], T[1], None), ("c#y", None, ["c#x"], T[1], None)]
    t = orphan_tables(spark, ring, [], [])
    assert {(r.src_key, r.kind) for r in orphans.orphan_cascade(*t).collect()} == {("c#x", "direct"), ("c#y", "inherited")}
    assert orphans.orphan_report(*orphan_tables(spark, [], [], [])).count() == 0


CORPUS = [
    ("a1", "A", "v1.0.0", "SECTION", 5, "5", "General"), ("a2", "A", "v1.0.0", "NORM", 5, "5", "Providers shall keep audit logs of all events"), ("a3", "A", "v1.0.0", "NORM", 6, "5.1", "A risk assessment shall be carried out"),
    ("a4", "A", "v1.0.0", "INFORM", 7, "5.1", "NOTE: the risk method may vary"), ("b1", "B", "v2.0.0", "NORM", 3, "6", "Keys shall be re-keyed; logs of audit"), ("b2", "B", "v2.0.0", "INFORM", 4, "6", "Résumé of the audit"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, "id string, norm string, version string, type string, page int, section string, text string")


@pytest.mark.parametrize(
    ("query", "ids"),
    [("shall", "a2 a3 b1"), ("risk", "a3 a4"), ("risk assessment", "a3"), ('"audit logs"', "a2"), ("audit logs", "a2 b1"), ("assessment OR method", "a3 a4"), ("ass* shall", "a3"), ("audit NOT keys", "a2 b2"), ("resume", "b2"), ("zzz", ""), ("re-keyed", "b1")],
)
def test_search(corpus, query, ids):
    assert " ".join(sorted(r.id for r in retrieval.bm25(retrieval.build_index(corpus), query).collect())) == ids


def test_scores_equal_the_formula(corpus):
    import math

    words = {r[0]: retrieval.re.findall(r"\w+", r[6].lower()) for r in CORPUS}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    df = sum("shall" in w for w in words.values())
    idf = max(math.log((n - df + 0.5) / (df + 0.5)), 0) or 1e-6
    got = {r.id: r.score for r in retrieval.bm25(retrieval.build_index(corpus), "shall").collect()}
    for k in ("a2", "a3", "b1"):
        tf = words[k].count("shall")
        assert got[k] == pytest.approx(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[k]) / avg)))


def test_hybrid_search_and_lookups(spark, corpus):
    import math

    vec = lambda i: [v / math.sqrt(sum(math.sin(i + j) ** 2 for j in range(4))) for v in (math.sin(i + j) for j in range(4))]
    vectors = spark.createDataFrame([(r[0], vec(i)) for i, r in enumerate(CORPUS)], "id string, embedding array<float>")
    index = retrieval.build_index(corpus)
    assert retrieval.vector_scores(vectors, vec(0), 1).first().score > 0.995
    assert retrieval.vector_scores(vectors, vec(2), 1, "cosine").first().id == "a3"
    found = retrieval.search_norm(corpus, index, vectors, "risk", vec(2), limit=999)
    assert found.first().id == "a3" and found.count() <= 20
    assert retrieval.search_norm(corpus, index, vectors, "risk", vec(2), alpha=0).agg(F.max("bm25")).first()[0] == 0
    assert {r.id for r in retrieval.search_norm(corpus, index, None, "shall", norm="b", alpha=1).collect()} == {"b1"}
    assert [r.id for r in retrieval.section_rows(corpus, "a", "5").collect()] == ["a1", "a2", "a3", "a4"]
    assert retrieval.section_rows(corpus, "a", "99").count() == 0
    assert [r.id for r in retrieval.contents(corpus, "A").collect()] == ["a1"]


def test_neighbours_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.random() for _ in range(6)]) for i in range(120)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): r.id for r in retrieval.knn_join(v, v.where("id % 20 = 0"), 5, block=2).collect()}
    for q, e in rows[::20]:
        order = sorted((sum((a - b) ** 2 for a, b in zip(e, x)), i) for i, x in rows if i != q)
        assert [got[q, k + 1] for k in range(5)] == [i for _, i in order[:5]]


def test_vector_index_against_the_exact_search(spark):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(centres[:1] * 6 + centres)]) for i in range(1500)] + [(9000, None)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>")
    index, asked = retrieval.vector_index(v, sample=300), v.where("id % 20 = 0")
    assert index.rows.count() == 1500 and len(index.centres) == 32
    pairs = lambda df: {(r.query_id, r.id) for r in df.collect()}
    exact, found = pairs(retrieval.knn_join(v.where("id < 9000"), asked.where("id < 9000"), 10)), pairs(retrieval.index_search(index, asked, 10, block=40))
    assert len(found & exact) >= 0.9 * len(exact) and len(found) == 750
    assert pairs(retrieval.index_search(index, asked, 10, probes=32)) == exact and 1 <= retrieval.probes_for(index, 10) < 16
    assert retrieval.index_search(retrieval.vector_index(v.limit(0)), asked, 3).count() == 0 and retrieval.index_search(index, asked.limit(0), 3).count() == 0


def test_references(spark):
    text = "ETSI EN 319 401, TS119 612-1? TS 119 612-1; RFC 3161 and RFC5280, SD-JWT VC; ISO/IEC 18013–5; ITU-T X.509; W3C Recommendation, W3C VC-DM; OpenID4VP 1.0, OpenID4VCI, HAIP"
    refs = {(r.source, r.ref) for r in graph.reference_rows(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string"), "doc_id").collect()}
    assert refs == {("spec", "EN 319 401"), ("spec", "TS 119 612-1"), ("ietf", "RFC 3161"), ("ietf", "RFC 5280"), ("ietf", "SD-JWT VC"), ("iso", "ISO 18013-5"), ("itu", "ITU-T X509"), ("w3c", "W3C VC-DM"), ("openid", "OpenID4VP"), ("openid", "OpenID4VCI"), ("openid", "HAIP")}


def test_reach_and_degrees(spark):
    e = graph.clean_edges(spark.createDataFrame([(1, "a", "B ", "n", "s"), (2, "b", "c", "n", "s"), (3, "c", "a", "n", "s"), (4, "c", "d", "n", "s"), (5, "d", "d", "n", "s"), (6, None, "d", "n", "s")], "edge_id long, from_id string, to_id string, type string, source string"))
    roots = spark.createDataFrame([("a",)], "id string")
    assert {(r.id, r.depth) for r in graph.reachable(e, roots, 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert {r.id for r in graph.reachable(e, roots, 9).collect()} == {"a", "b", "c", "d"}
    assert {r.id: (r.in_degree, r.out_degree) for r in graph.degrees(e).collect()} == {"a": (1, 1), "b": (1, 1), "c": (1, 2), "d": (1, 0)}


def test_continued_tables_and_virtual_pages(spark):
    h = ["k", "v"]
    rows = [("d", 0, 1, 0.5, 0.9, [h, ["1", "a"]]), ("d", 1, 2, 0.1, 0.95, [h, ["2", "b"]]), ("d", 2, 3, 0.05, 0.4, [h, ["3", "c"]]), ("d", 3, 4, 0.1, 0.3, [h, ["4", "d"]])]
    out = sequences.merged_tables(spark.createDataFrame(rows, "doc string, pos int, page int, top double, bottom double, rows array<array<string>>")).orderBy("first_page").collect()
    assert [(r.first_page, r.pages, [x[0] for x in r["rows"]]) for r in out] == [(1, 3, ["k", "1", "2", "3"]), (4, 1, ["k", "4"])]
    p = spark.createDataFrame([("d", i, "x" * 1100) for i in range(7)], "doc string, pos long, text string")
    assert [r.page for r in sequences.virtual_pages(p).orderBy("pos").collect()] == [1, 1, 1, 2, 2, 2, 3]


def test_contents_mode_is_left_for_good_after_six_pages(spark):
    pages = spark.createDataFrame([("d", i, n) for i, n in enumerate([3, 4, 0, 3, 3, 3, 3, 3, 3, 0, 5], 1)], "doc string, page int, n_lines int")
    assert [r.page for r in sequences.contents_mode(pages).where("toc_mode").orderBy("page").collect()] == [1, 2, 4, 5, 6, 7, 8]


def test_blocks_from_glyphs(spark):
    g = [("d", 1, c, 100.0 + 12 * ln, 110.0 + 12 * ln, 10.0 * i, 10.0 * i + 9, 11.0, "Times-Bold" if ln == 0 else "Times") for ln, s in enumerate(["1 Scope", "It shall"]) for i, c in enumerate(s)]
    g += [("d", 1, c, 300.0, 310.0, 10.0 * i, 10.0 * i + 9, 11.0, "Times") for i, c in enumerate("NOTE: x")]
    glyphs = spark.createDataFrame(g, "doc string, page int, text string, top double, bottom double, x0 double, x1 double, size double, fontname string")
    out = blocks.text_blocks(glyphs).orderBy("y_top").collect()
    assert [r.text for r in out] == ["1 Scope It shall", "NOTE: x"] and 0 < out[0].bold < 1
    placed = blocks.text_blocks(glyphs, 5).withColumns({"height": F.lit(800.0), "profile": F.lit("etsi-spec"), "toc_mode": F.lit(False)})
    assert [r.type for r in classes.classified_blocks(placed).orderBy("y_top").collect()] == ["SECTION", "NORM", "INFORM"]
    boxes = spark.createDataFrame([("d", 1, (0.0, 290.0, 500.0, 320.0))], "doc string, page int, bbox struct<x0:double,top:double,x1:double,bottom:double>")
    assert blocks.outside_boxes(glyphs, boxes).count() == 15
    q = blocks.gap_quality(glyphs, [5, 40, 500])
    assert {(r.gap, r.n) for r in q.collect()} == {(5, 3), (40, 2), (500, 1)} and blocks.best_gap(q, 10).first().gap == 40


def test_incremental_runs(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, crc string")
    assert [r.path for r in incremental.pending(files, spark.createDataFrame([("a", "1"), ("b", "x")], "path string, crc string")).collect()] == ["b"]
    old = spark.createDataFrame([(1, "x", 1), (2, "y", 5)], "k int, v string, t int")
    new = spark.createDataFrame([(1, "n", 2), (2, "o", 4), (3, "p", 1)], "k int, v string, t int")
    assert {(r.k, r.v) for r in incremental.upsert(old, new, ["k"], ["t"]).collect()} == {(1, "n"), (2, "y"), (3, "p")}
    assert {(r.k, r.v) for r in incremental.insert_missing(old, new, "k").collect()} == {(1, "x"), (2, "y"), (3, "p")}
    once = incremental.evolve(old, {"abbr": "string", "v": "int"})
    assert once.columns == ["k", "v", "t", "abbr"] and incremental.evolve(once, {"abbr": "string"}).columns == once.columns
    s = "url string, etag string, length long"
    state = incremental.change_state(spark.createDataFrame([("a", "1", 1), ("b", None, 5), ("c", None, None)], s), spark.createDataFrame([("a", "1", 2), ("b", "2", 6), ("c", None, 1), ("d", "x", 1)], s))
    assert {r.url: r.state for r in state.collect()} == {"a": "same", "b": "changed", "c": "unknown", "d": "unknown"}


def test_length_quantiles_by_index(spark):
    n = [5, 1, 9, 200, 7, 7, 3, 2, 120, 40, 11]
    row = profiles.length_quantiles(spark.createDataFrame([("T", "x" * k) for k in n], "type string, text string")).first()
    s = sorted(n)
    assert (row.median, row.p10, row.p90, row.short) == (s[5], s[len(s) // 10], s[len(s) * 9 // 10], 9)


def test_reference_sections(spark):
    text = "1 Scope\nSee RFC 9.\nNormative references\nEN 319 401, RFC 3161\nInformative references\nRFC 3161, RFC 5280\n3 Terms"
    out = {r.k: r for r in graph.section_references(spark.createDataFrame([(1, text), (2, "Only RFC 9999 here"), (3, None), (4, "")], "k int, text string"), "k").collect()}
    assert sorted(out[1].normative) == ["EN 319 401", "RFC 3161"] and out[1].informative == ["RFC 5280"] and len(out[1].all) == 3
    assert out[2].normative == [] and out[2].all == ["RFC 9999"] and 3 not in out and out[4].all == []


def test_graph_views(spark):
    n = spark.createDataFrame([("a", True), ("b", True), ("x", False), ("lone", True)], "id string, known boolean")
    e = spark.createDataFrame([("a", "b", "normative"), ("a", "x", "normative"), ("b", "a", "informative")], "from_id string, to_id string, type string")
    nodes, edges = graph.visible(n, e)
    assert {r.id for r in nodes.collect()} == {"a", "b", "x"} and edges.count() == 2
    nodes, edges = graph.visible(n, e, ("normative", "informative"), stubs=False, roots=n.where("id = 'b'"))
    assert {r.id for r in nodes.collect()} == {"a", "b"} and edges.count() == 1


def test_milestones(spark):
    rows = [("d", 1, "start", "2024-01-01"), ("d", 2, "draft", "2024-02-01"), ("d", 3, "vote", None), ("d", 4, "publish", None), ("e", 1, "start", None)]
    out = {r.doc: (r.last_done, r.pending) for r in sequences.milestone_state(spark.createDataFrame(rows, "doc string, pos int, name string, achieved string")).collect()}
    assert out == {"d": ("draft", ["vote", "publish"]), "e": (None, ["start"])}
