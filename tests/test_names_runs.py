"""Names, files, runs, work items, connectors and sinks on fixtures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clausemill.functions import identifiers as I
from clausemill.operators import incremental, names, programme
from clausemill.sources import connect, sinks

T = [datetime(2024, m, 1) for m in range(1, 7)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (I.archive_key, "ESI-0019401v331v322", "EN 319 401"), (I.archive_key, "esi-0019102-1v151", "EN 319 102-1"), (I.archive_key, "EN 319 401", None), (I.archive_key, "ESI-0019401", None),
        (I.archive_key_version, "ESI-0019401v331v322", "v3.3.1"), (I.archive_key_version, "ESI-0019401v33v32", "v3.3"), (I.archive_key_version, "ESI-0019401v002", "v0.0.2"), (I.archive_key_version, "ESI-0019401v12", "v12"), (I.archive_key_version, "x", None),
        (I.docx_doc_id, "ESI-0019472-2v111.docx", "TS 119 472-2"), (I.docx_doc_id, "ts_119_495-01 x.docx", "TS 119 495-1"), (I.docx_doc_id, "minutes.docx", None),
        (I.html_doc_id, "OpenID_Connect_Core.html", "OpenID Connect Core"), (I.text_doc_id, "rfc7515.txt", "RFC 7515"), (I.text_doc_id, "notes.txt", None), (I.archive_key, None, None),
    ],
)
def test_archive_and_file_names(spark, f, value, want):
    assert frame(spark, [(value,)], "c string").select(f(F.col("c"))).first()[0] == want


def test_aliases(spark):
    rows = frame(spark, [("EN 319 401-2", "v3.3.1", "ESI-0019401-2v331"), ("EN 319 401-2", "v3.3.1", "ESI-0019401-2v331"), (None, "v1", "f"), ("odd", None, None)], "norm string, version string, source_file string")
    titles = frame(spark, [("EN 319 401-2", "EN 319401", "77"), (None, "x", "1")], "norm string, number string, wki_id string")
    got = {r.alias: (r.norm, r.alias_type) for r in names.build_aliases(rows, titles).collect()}
    assert got == {a: ("EN 319 401-2", t) for a, t in (("EN 319401", "short"), ("EN 319401 v3.3.1", "full"), ("wki:77", "work_item"), ("ESI-0019401-2v331", "archive_key"), ("ESI-0019401-2", "archive_prefix"), ("319 401-2", "short"), ("319401-2", "short"), ("ETSI EN 319 401-2", "short"))}
    assert names.build_aliases(rows.limit(0), titles.limit(0)).count() == 0


def test_resolving(spark):
    norms = frame(spark, [("EN 319 401",), ("TS 119 612",), ("ESI-0019411v241",), (None,)], "norm string")
    aliases = frame(spark, [("sd-jwt", "SD-JWT"), ("mdl", None), (None, "x")], "alias string, norm string")
    asked = ["319401", "ETSI EN 319 401", "119-612", "ts 119 612", "EN 319 411", "SD JWT", "mdl", "nothing", "", "EN 319 401"]
    got = {r.asked: r.norm for r in names.resolve_names(norms, aliases, asked).collect()}
    assert got == {"319401": "EN 319 401", "ETSI EN 319 401": "EN 319 401", "119-612": "TS 119 612", "ts 119 612": "TS 119 612", "EN 319 411": "ESI-0019411v241", "SD JWT": "SD-JWT", "mdl": "mdl", "nothing": "nothing", "": "EN 319 401", "EN 319 401": "EN 319 401"}
    assert names.resolve_names(norms, aliases, []).count() == 0 and names.resolve_names(norms.limit(0), aliases.limit(0), ["x"]).first().norm == "x"


def test_display_and_short_names(spark):
    c = frame(spark, [("ESI-0019401v331", "v3.3.1", " A title "), ("EN 1", None, None), ("EN 2", "v1.1.1", "x" * 100)], "norm string, version string, title string")
    assert [r.display_name for r in names.display_names(c).collect()] == ["EN 319 401 v3.3.1 — A title", "EN 1", "EN 2 v1.1.1 — " + "x" * 77 + "..."]
    docs = frame(spark, [("EN 1", "old"), ("EN-2", None), ("EN 3", None)], "norm string, shortname string")
    s = frame(spark, [("en1", "Side")], "norm string, shortname string")
    st = frame(spark, [("EN 1", "Stat"), ("EN 2", "Two"), (None, "x")], "norm string, shortname string")
    assert {r.norm: (r.shortname, r.shortname_source) for r in names.short_names(docs, s, st).collect()} == {"EN 1": ("Side", "sidecar"), "EN-2": ("Two", "static"), "EN 3": ("", "")}
    b = names.backfilled_keys(frame(spark, [("ESI-0019401v331v322", "vX.X.X"), ("ESI-0019401v221", "v9.9.9"), ("EN 1", "vX.X.X"), (None, None)], "norm string, version string"))
    assert [tuple(r) for r in b.collect()] == [("EN 319 401", "v3.3.1"), ("EN 319 401", "v9.9.9"), ("EN 1", "vX.X.X"), (None, None)]


def test_files_and_urls(spark):
    files = frame(spark, [("p/en_319401v030301p.pdf", "en_319401v030301p.pdf"), ("p/ESI-0019102-1v151.pdf", "ESI-0019102-1v151.pdf"), ("p/ESI-0019102-2v151.pdf", "ESI-0019102-2v151.pdf"), ("p/ts_1194951.pdf", "ts_1194951.pdf"), ("p/none.pdf", "none.pdf")], "path string, name string")
    numbers = frame(spark, [("EN 319 401",), ("ESI-0019102-2",), ("ESI-0019102-3",), ("TS 119 495-1",), ("EN 999 999",), ("EN 1",), (None,)], "number string")
    assert {r.number: r.path for r in names.files_of_numbers(numbers, files).collect()} == {"EN 319 401": "p/en_319401v030301p.pdf", "ESI-0019102-2": "p/ESI-0019102-2v151.pdf", "ESI-0019102-3": None, "TS 119 495-1": "p/ts_1194951.pdf", "EN 999 999": None, "EN 1": None}
    u = "path string, url string"
    items = frame(spark, [(1, "EN 319 401", "first"), (2, "EN 319 401", "last"), (3, "TS 119 495-1", "seven"), (4, None, "x")], "pos int, number string, url string")
    got = {r.path: (r.url, r.source) for r in names.urls_of_files(files, frame(spark, [("p/none.pdf", "side")], u), frame(spark, [("p/none.pdf", "res"), ("p/ESI-0019102-1v151.pdf", "res")], u), items).collect()}
    assert got["p/none.pdf"] == ("side", "sidecar") and got["p/ESI-0019102-1v151.pdf"] == ("res", "results") and got["p/en_319401v030301p.pdf"] == ("last", "item") and got["p/ts_1194951.pdf"] == ("seven", "item") and got["p/ESI-0019102-2v151.pdf"] == (None, None)
    pages = frame(spark, [("a", "5", None), ("b", "unknown", "WKI_ID=9"), ("c", "unknown", "wki_id=8"), ("d", None, "")], "number string, wki_id string, html string")
    assert {r.number: (r.wki_id, r.source) for r in names.repaired_work_items(pages, frame(spark, [("b", "x?WKI_ID=7")], "number string, url string")).collect()} == {"a": ("5", "recorded"), "b": ("7", "overview"), "c": ("8", "page"), "d": (None, None)}


def test_runs(spark):
    src = frame(spark, [("a", T[1]), ("b", T[3]), ("c", T[1])], "stem string, modified timestamp")
    assert {r.stem for r in incremental.changed_since(src, frame(spark, [("a", T[2]), ("b", T[2])], "stem string, modified timestamp")).collect()} == {"b", "c"}
    r = "number string, path string"
    idx = incremental.results_index(frame(spark, [("1", "x"), ("1", "y"), ("2", "z")], r), frame(spark, [("2", "w")], r), frame(spark, [(None, "v")], r))
    assert {(x.number, x.path, x.bucket) for x in idx.collect()} == {("1", "y", "success"), ("2", "w", "redownloaded")}
    b = "number string, bucket string"
    now, before = frame(spark, [("1", "failed"), ("2", "failed"), ("3", "success"), ("4", "noDownload")], b), frame(spark, [("1", "redownloaded"), ("3", "success")], b)
    entry = {(x.kind, x.number): x.n for x in incremental.history_entry(now, before, "2024-01-01 00:00:00").collect()}
    assert entry[("count:failed", None)] == 2 and entry[("regression", "1")] == 1 and ("regression", "2") not in entry and ("problem", "4") in entry
    docs = frame(spark, [("EN 1", "", None, "old", None, None), ("EN 2", "S", "sidecar", None, "kept", "")], "norm string, shortname string, shortname_source string, short_title string, full_title string, own_short_title string")
    titles = frame(spark, [("en-1", "new", "full", "own"), ("EN2", None, "other", "o")], "number string, short_title string, full_title string, own_short_title string")
    assert [tuple(x) for x in incremental.patched_titles(docs, titles).orderBy("norm").collect()] == [("EN 1", "", "", "new", "full", "own"), ("EN 2", "S", "sidecar", None, "kept", "o")]
    items = frame(spark, [("EN 1",), ("EN 2",), ("EN 3",), ("EN 4",)], "number string")
    done = frame(spark, [("EN1", "A title"), ("EN2", "Title 1 Title 2"), ("EN3", "")], "number string, full_title string")
    stop = frame(spark, [("EN-4",)], "number string")
    assert [x.number for x in incremental.to_enrich(items, done, stop).orderBy("number").collect()] == ["EN 2", "EN 3"]
    assert [x.number for x in incremental.to_enrich(items, done, stop, only="en_1").collect()] == ["EN 1"] and incremental.to_enrich(items, done, stop, limit=1).count() == 1
    assert incremental.first_occurrences(frame(spark, [("a", 2), ("a", 1), ("b", 3)], "k string, o int"), "k", "o", 1).collect()[0].o == 1
    want = frame(spark, [("f", 2), ("g", 1), ("h", 1)], "source_file string, n_expected long")
    rows = frame(spark, [("f", "NORM", 1), ("f", "INFORM", 1), ("g", "NORM", 0), (None, "NORM", 1)], "source_file string, type string, has_embedding int")
    assert {x.source_file: x.ok for x in incremental.index_check(want, rows, frame(spark, [("f",), ("g",), ("h",)], "source_file string")).collect()} == {"f": True, "g": False, "h": False}


def test_work_items(spark):
    rows = [(0, "EN 1", 5, "Drafting\nStage", T[0].date(), T[2].date()), (1, "EN 1", 5, "Published", None, None), (2, "EN 1", 3, "x", None, None), (3, None, 9, "x", None, None), (4, "TS 2", 1, None, T[1].date(), None), (5, "TR 3", 1, "On approval", None, None)]
    cur = programme.current_items(frame(spark, rows, "pos int, number string, work_item_id int, stage string, status_date date, next_date date"))
    items = cur.withColumns({"active": programme.is_active(F.col("stage"), ("Drafting", "approval")), "kind": F.left("number", F.lit(2)), "title": F.lit("a | title")})
    assert {(r.number, r.pos, r.active) for r in items.collect()} == {("EN 1", 0, True), ("TS 2", 4, False), ("TR 3", 5, True)}
    assert [r.number for r in programme.by_due_date(items).collect()] == ["EN 1", "TR 3"] and [r.number for r in programme.by_publication(items).collect()] == ["TS 2"]
    assert [(r.month, r.at, r.number) for r in programme.upcoming(items, "2024-01-15").collect()] == [("2024-03", 1, "EN 1")] and programme.upcoming(items, "2025-01-15").count() == 0
    lines = programme.report_lines(items, "2024-01-15", [("first", "en"), ("second", "t")]).orderBy("part", "pos").collect()
    assert [r.part for r in lines] == ["1 active", "1 active", "2 category first", "2 category second", "3 published TS", "4 due 2024-03"] and "a \\| title" in lines[0].line
    assert programme.report_lines(items.limit(0), "2024-01-15", []).count() == 0


def test_connectors_try_again_and_give_up(spark):
    class Flaky:
        asked = 0

        def get(self, url):
            self.asked += 1
            if "bad" in url or ("flaky" in url and self.asked % 2):
                raise OSError("no answer")
            return connect.Answer(200, url.encode(), {"etag": "1"})

    asked = frame(spark, [("http://x/flaky",), ("http://x/bad",), (None,), ("http://x/good",)], "url string").coalesce(1)
    got = {r.url: r for r in connect.fetched(asked, Flaky, pause=0).collect()}
    assert got["http://x/flaky"].status == 200 and bytes(got["http://x/good"].body) == b"http://x/good" and got["http://x/good"].headers == {"etag": "1"}
    assert got["http://x/bad"].error == "no answer" and got[None].error == "no URL"
    many = frame(spark, [(f"http://x/bad{i}",) for i in range(15)], "url string").coalesce(1)
    assert [r.error for r in connect.fetched(many, Flaky, tries=1, pause=0).collect()] == ["no answer"] * 11 + ["not asked"] * 4
    pages = connect.page_requests(spark, "http://x/?offset={offset}", 45, 20)
    assert [r.url[-2:] for r in pages.orderBy("offset").collect()] == ["=0", "20", "40"] and connect.page_requests(spark, "x", 0, 20).count() == 0
    cached = frame(spark, [("http://x/good", T[1]), ("http://x/bad", T[0])], "url string, fetched_at timestamp")
    assert {r.url for r in connect.still_needed(asked, cached, "2024-02-01 01:00:00", 8 * 3600).collect()} == {"http://x/flaky", "http://x/bad", None}
    names_ = frame(spark, [({"content-disposition": 'attachment; filename="a b.pdf"'}, "http://x/y.zip", "n"), ({}, "http://x/y.zip?z=1", "n"), ({}, "http://x/", "EN 1")], "h map<string,string>, u string, n string")
    assert [r[0] for r in names_.select(connect.file_name(F.col("h"), F.col("u"), F.col("n"))).collect()] == ["a_b.pdf", "y.zip", "EN_1"]


def test_sinks(spark, tmp_path):
    pages = frame(spark, [("N1", 1, "a"), ("N2", 1, "b")], "norm string, page int, text string")
    for rows in (pages, pages.where("norm = 'N2'").withColumn("text", F.lit("c"))):
        sinks.write_specs(rows, str(tmp_path / "specs"))
    assert {(r.norm, r.text) for r in spark.read.parquet(str(tmp_path / "specs")).collect()} == {("N1", "a"), ("N2", "c")}
    sinks.write_lines(frame(spark, [(2, "a", "last"), (1, "b", "second"), (1, "a", "first")], "part int, pos string, line string"), str(tmp_path / "lines"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "lines").glob("part-*"))) == "first\nsecond\nlast\n"
    for k in range(2):
        sinks.append_history(frame(spark, [(k,)], "n int"), str(tmp_path / "history"))
        sinks.append_missing(frame(spark, [(1, "x"), (1 + k, "y")], "k int, v string"), str(tmp_path / "rows"), "k")
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2 and {r.k for r in spark.read.parquet(str(tmp_path / "rows")).collect()} == {1, 2}
    g = sinks.graph_json(frame(spark, [("a", True)], "id string, known boolean"), frame(spark, [("a", "b")], "from_id string, to_id string")).collect()
    assert [r.json for r in g] == ['{"id":"a","known":true}', '{"from_id":"a","to_id":"b"}']


def test_models_vectors_and_small_selections(spark):
    from clausemill.functions import embedding
    from clausemill.sources import files

    def model():
        asked = []

        def ask(p):
            asked.append(p)
            if "bad" in p:
                raise OSError
            return f"{p}:{len(asked)}"

        return ask

    df = frame(spark, [("a",), ("a",), ("bad",), (None,)], "p string").coalesce(1)
    got = [r[0] for r in df.select(embedding.answered(model, "BREAK")(F.col("p"))).collect()]
    assert got[0] == got[1] and got[0].startswith("a:") and got[2:] == ["BREAK", "BREAK"]

    def served():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    v = frame(spark, [("abc",), ("",), (None,)], "t string").coalesce(1).select(embedding.embedder(served)(F.col("t")).alias("v"))
    assert [r.v for r in v.collect()] == [[3.0, 1.0], [0.0, 1.0], [0.0, 1.0]]
    assert [r[0] for r in v.select(embedding.unpacked(embedding.packed(F.col("v")))).collect()][0] == [3.0, 1.0]

    def absent():
        raise OSError

    assert embedding.first_backend([("a", absent), ("b", lambda: False), ("c", lambda: True)]) == "c" and embedding.first_backend([]) is None
    links = frame(spark, [("k", "/x/01.02.01_60/a.pdf"), ("k", "/x/02.01.01_60/a.pdf"), ("k", "/x/02.01.01_60/b.PDF"), ("k", "/x/03.01.01/readme.txt"), ("m", "plain.pdf")], "key string, href string")
    assert {r.key: r.url for r in files.latest_delivery(links).collect()} == {"k": "/x/02.01.01_60/b.PDF", "m": "plain.pdf"}
    f = frame(spark, [("p/A.pdf", "A.pdf", "a", T[0]), ("q/a.pdf", "a.pdf", "a", T[1]), ("p/b.docx", "b.docx", "b", T[0])], "path string, name string, stem string, modified timestamp")
    assert files.named_like(f, "A.P").count() == 2
    assert [r.path for r in files.page_files_of(frame(spark, [("a", "pdf"), ("b", "pdf"), ("c", "docx")], "stem string, source_kind string"), f).collect()] == ["q/a.pdf"]
    assert incremental.to_resegment(f, frame(spark, [("b",), ("b",), (None,)], "stem string")).count() == 1
    both = incremental.all_items(frame(spark, [("1", 5)], "number string, n int"), frame(spark, [("2",)], "number string"))
    assert {(r.number, r.n, r.list) for r in both.collect()} == {("1", 5, "active"), ("2", None, "published")}
    u = incremental.url_records(frame(spark, [("p", "http://x/deliver/a"), ("q", None)], "path string, url string"), "2024-01-01").collect()
    assert [(r.path, r.source) for r in u] == [("p", "delivery")]
