"""Contents, classes, segmentation, page parts and markup on fixtures."""

from pyspark.sql import functions as F

from clausemill.functions import text as X
from clausemill.functions import web
from clausemill.operators import blocks, classes, contents, graph, profiles, retrieval, segmenting, sequences
from clausemill.sources import markup

COVER = "ETSI EN 1 V1.1.1\nRules for sealed boxes\nMarch 2024"
TOC1, TOC2 = "Contents\n1 Scope ........ 6\n2 References ....... 6\n4.1   Boxes      7\nForeword ....... 5", "Annex A (normative): Forms ....... 9"


def pages(spark):
    rows = [("d", 1, 0, COVER), ("d", 2, 0, TOC1), ("d", 3, 0, TOC2), ("d", 4, 0, "nothing here"), ("d", 5, 0, "Foreword\nx\nFOREWORD\nModal verbs terminology"), ("d", 6, 0, "1 Scope\nThe box shall close, see clause 4.1\nand\nIntroduction"), ("d", 7, 0, "goes on. Done"), ("e", 1, 0, "Draft\nOnly text"), ("f", 1, 0, None)]
    return spark.createDataFrame(rows, "doc string, page int, at int, text string")


def test_contents(spark):
    lines = contents.page_lines(pages(spark))
    e = [(r.num, r.title, r.to_page, r.form) for r in contents.entries(lines).orderBy("page", "pos").collect()]
    assert e == [("1", "Scope", 6, "leader"), ("2", "References", 6, "leader"), ("4.1", "Boxes", 7, "leader"), ("", "Foreword", 5, "unnumbered"), ("Annex A", "Forms", 9, "annex")]
    assert [(r.page, r.n_entries) for r in contents.contents_pages(lines).orderBy("page").collect()] == [(2, 4), (3, 1)]
    s = {r.doc: r for r in contents.structure(lines).collect()}
    assert (s["d"].body_start, s["d"].between, s["d"].cover_title, s["d"].date, s["d"].toc_pages) == (6, ["foreword", "modal verbs terminology"], "Rules for sealed boxes", "March 2024", [2, 3])
    assert (s["e"].body_start, s["e"].toc_pages, s["e"].cover_title, s["e"].n_entries) == (None, None, "Only text", 0) and "f" not in s
    assert {(r.heading, r.documents) for r in contents.heading_frequencies(contents.structure(lines)).collect()} == {("foreword", 1), ("modal verbs terminology", 1)}
    assert contents.structure(lines.limit(0)).count() == 0
    report = contents.report(contents.structure(lines), contents.entries(lines)).orderBy("part", "pos").collect()
    assert [r.part for r in report].count(4) == 2 and any("page 6: 1 documents" in r.line for r in report)
    own = contents.entries(lines).where("num <> ''")
    sec = {r.num: r for r in contents.sections(own, pages(spark).where("text IS NOT NULL").select("doc", "page", "text")).collect()}
    assert (sec["1"].page_from, sec["1"].page_to, sec["1"].cross_refs, sec["1"].keywords) == (6, 6, ["4.1"], ["shall"]) and sec["4.1"].page_to == 8 and sec["Annex A"].text == ""


def test_classes_of_blocks_and_profiles(spark):
    rows = [
        ("etsi-spec", "ETSI EN 319 401", 10.0, 20.0, 10.0, 0.0, 1, "HEADER"), ("etsi-spec", "whatever", 10.0, 20.0, 10.0, 0.0, 2, "HEADER"), ("etsi-spec", "whatever", 10.0, 20.0, 10.0, 0.0, 1, "OTHER"), ("etsi-spec", "12", 780.0, 795.0, 10.0, 0.0, 3, "FOOTER"),
        ("etsi-spec", "Important Notice", 300.0, 310.0, 10.0, 0.0, 2, "OTHER"), ("etsi-spec", "5.1 General rules", 300.0, 310.0, 14.0, 0.0, 9, "SECTION"), ("etsi-spec", "5.1 General rules", 300.0, 310.0, 9.0, 0.0, 9, "OTHER"),
        ("ietf-rfc", "5.1 General rules", 300.0, 310.0, 10.6, 0.45, 9, "SECTION"), (None, "NOTE: shall", 300.0, 310.0, None, None, 9, "INFORM"), ("x", "Table 3: x shall", 300.0, 310.0, 10.0, 0.0, 9, "TABLE"), ("x", "It shall.", 300.0, 310.0, 10.0, 0.0, 9, "NORM"), ("x", None, 300.0, 310.0, 10.0, 0.0, 9, "OTHER"),
    ]
    df = spark.createDataFrame(rows, "profile string, text string, y_top double, y_bot double, size double, bold double, page int, want string").withColumns({"height": F.lit(800.0), "toc_mode": F.lit(False)})
    assert all(r.type == r.want for r in classes.classified_blocks(df).collect())
    asked = classes.classified_blocks(df.where("size = 9.0"), is_heading=lambda t: t.startswith("5"))
    assert asked.first().type == "SECTION" and classes.classified_blocks(df.where("want = 'FOOTER'"), inverted=True).first().type == "HEADER"
    q = spark.createDataFrame([("NOTE 1: may", "INFORM"), ("Figure 2", "TABLE"), ("It must", "NORM"), ("Title ...... 5", "TOC"), ("x", "OTHER")], "t string, want string")
    assert all(r.k == r.want for r in q.select("want", classes.quick_class(F.col("t")).alias("k")).collect())
    p = spark.createDataFrame([("d", 0, "SECTION", "4.1 Scope"), ("d", 1, "NORM", "x"), ("d", 2, "SECTION", "Unnumbered"), ("d", 3, "NORM", None)], "doc string, pos int, type string, text string")
    assert [(r.section, r.section_title) for r in classes.carried_sections(p).orderBy("pos").collect()] == [("4.1", "Scope"), ("4.1", "Scope"), ("4.1", "Unnumbered"), ("4.1", "Unnumbered")]


def test_blocks_repeat_the_last_one_that_was_kept(spark):
    rows = [("d", 1, i, t, y) for i, (t, y) in enumerate([("a", 0.0), ("a", 4.0), ("a", 8.0), ("b", 9.0), ("a", 9.5), (None, 10.0), (None, 10.5)])]
    out = blocks.without_repeats(spark.createDataFrame(rows, "doc string, page int, block int, text string, y_top double")).orderBy("y_top")
    assert [r.y_top for r in out.collect()] == [0.0, 8.0, 9.0, 9.5, 10.0, 10.5]
    j = blocks.judged(spark.createDataFrame([("d", 8, 20, 200.0, 0.1), ("d", 20, 3, 300.0, 0.1), ("d", 40, 20, 90.0, 0.1), ("e", 8, 10, 200.0, 0.1)], "doc string, gap int, n long, median double, short_share double"), spark.createDataFrame([("e", 100)], "doc string, baseline_n int"))
    assert {r.verdict: r.n for r in blocks.tally(j).collect()} == {"ok": 1, "bad": 1, "collapsed": 2}


def test_segments_of_paragraphs_and_pages(spark):
    rows = [("d", 0, "p", "Heading 1", "4 Scope", 0.0, None), ("d", 1, "p", "Normal", "The box shall close.", 0.0, None), ("d", 2, "tbl", None, "a | b", 0.0, [["a", None], ["", None], ["1", "2"]]), ("d", 3, "p", None, " ", 0.0, None), ("d", 4, "error", None, None, None, None)]
    out = segmenting.segment_paragraphs(spark.createDataFrame(rows, "doc string, pos int, kind string, style string, text string, bold double, rows array<array<string>>")).orderBy("pos").collect()
    assert [(r.type, r.section, r.section_title) for r in out] == [("SECTION", "4", "Scope"), ("NORM", "4", "Scope"), ("TABLE", "4", "Scope")] and out[1].keywords == ["shall"] and out[2].markdown.startswith("| a |")
    g = []
    for page, top, size, line in [(1, 100.0, 14.0, "4 Scope"), (1, 150.0, 10.0, "The box shall"), (1, 200.0, 10.0, "close and shall stay."), (2, 100.0, 10.0, "It may open."), (2, 300.0, 10.0, "cell text")]:
        g += [("d", page, c, top, top + 10, 10.0 * i, 10.0 * i + 9, size, "Sans") for i, c in enumerate(line)]
    glyphs = spark.createDataFrame(g, "doc string, page int, text string, top double, bottom double, x0 double, x1 double, size double, fontname string")
    box = "doc string, page int, bbox struct<x0:double,top:double,x1:double,bottom:double>, rows array<array<string>>"
    tables = spark.createDataFrame([("d", 2, (0.0, 290.0, 500.0, 320.0), [["k", "v" * 90], ["1", "2"]]), ("d", 2, (0.0, 90.0, 500.0, 120.0), [["small"]])], box)
    docs = spark.createDataFrame([("d", "etsi-spec", 800.0)], "doc string, profile string, height double")
    out = segmenting.segment_pages(glyphs, tables, docs).orderBy("pos").collect()
    assert [(r.type, r.page, r.section) for r in out] == [("SECTION", 1, "4"), ("NORM", 1, "4"), ("TABLE", 2, "4"), ("NORM", 2, "4")] and out[1].text == "The box shall close and shall stay."
    z = segmenting.zoned_text(glyphs, docs.select("doc", "height"), header=0.15).orderBy("page").collect()
    assert z[0].edge == "4 Scope" and z[0].body.startswith("The box") and z[0].chars == z[0].body_chars + 7
    im = segmenting.distinct_images(spark.createDataFrame([("d", 1, bytearray(b"x")), ("d", 3, bytearray(b"x")), ("d", 2, bytearray(b"y"))], "doc string, page int, content binary"))
    s = spark.createDataFrame([("d#1", "d", 1, 1), ("d#2", "d", 2, 4), ("d#3", "d", 4, 3)], "id string, doc string, page_from int, page_to int")
    assert sorted((r.id, r.page) for r in segmenting.images_in_sections(im, s).collect()) == [("d#1", 1), ("d#2", 2)]


PAGE = """<!-- etsiNumber: EN 1 --><!-- wkiId: unknown --><table><tr><td><b>Title</b></td><td>A <i>real</i> title<br><font color="#708090">Short one</font> x</td></tr></table>
<!-- Status Last Update --><b class="x">Drafting</b><table><tr><th>Milestone</th><th>Planned</th><th>Achieved</th></tr><tr><td>Start</td><td>2024-01-01</td><td>2024-01-05</td></tr><tr><td>Vote</td><td>2024-05-01</td><td>-</td></tr><tr><td></td><td>x</td><td></td></tr></table> STOPPED"""


def test_markup(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<table><tr><td>Title</td><td>Title 1</td></tr></table>")], "page_id int, html string")
    tables = markup.html_tables(df, "page_id", "html")
    t = {r.key: (r.full_title, r.short_title) for r in markup.labelled_titles(tables).collect()}
    assert t == {"1": ("A real title", "Short one"), "3": (None, None)}
    m = markup.milestones(tables).orderBy("pos").collect()
    assert [(r.milestone, r.target, r.achieved) for r in m] == [("Start", "2024-01-01", "2024-01-05"), ("Vote", "2024-05-01", None)]
    state = sequences.milestone_state(markup.milestones(tables).withColumnsRenamed({"key": "doc", "milestone": "name"})).first()
    assert (state.last_done, state.pending) == ("Start", ["Vote"]) and markup.schedules(tables).count() == 4
    assert {r.key: r.stopped for r in markup.stopped(df, "page_id", "html").collect()} == {"1": True, "2": False, "3": False}
    h = df.where("page_id = 1").select(web.status_after(F.col("html")).alias("s"), web.comment_field(F.col("html"), "etsiNumber").alias("n"), web.comment_field(F.col("html"), "wkiId").alias("w")).first()
    assert tuple(h) == ("Drafting", "EN 1", None)
    links = lambda *hrefs: [{"href": x, "label": ""} for x in hrefs]
    L = spark.createDataFrame([(links("a.zip", "http://www.etsi.org/deliver/x.zip", "b.docx "), "b.docx"), (links("eApproval/x.doc", "y.doc"), "y.doc"), (links("q.pdf", "http://etsi.org/deliver/z.ZIP"), "http://etsi.org/deliver/z.ZIP"), (links("x.pdf"), None), (None, None)], "l array<struct<href:string,label:string>>, want string")
    assert all(r.x == r.want for r in L.select("want", web.editable_link(F.col("l")).alias("x")).collect())
    one = lambda f, v: spark.createDataFrame([(v,)], "c string").select(f(F.col("c"))).first()[0]
    assert one(web.publication_title, "Electronic Signatures and Infrastructures (ESI);  A   title") == "A title" and one(web.publication_title, " ") is None
    assert one(web.plain_text_title, "x\nRequest for Comments: 7515\nCategory: y\nJSON  Web Signature\nz") == "JSON Web Signature" and one(web.plain_text_title, "none") is None
    assert one(lambda c: web.absolute_url(c, "http://h"), "/a?x=&y=1") == "http://h/a?y=1"
    assert [tuple(x) for x in one(X.figure_captions, "Figure 3: The box\nsee Figure 4\nTable A.1 – Forms ")] == [("figure", "3", "The box"), ("table", "A.1", "Forms")]
    assert one(X.decoded_list, '["a","b"]') == ["a", "b"] and one(X.decoded_list, "a") == ["a"] and one(X.decoded_list, None) == []
    assert one(lambda c: markup.cover_title(F.split(c, "\n")), "ETSI EN 319 401 V1.2.3 of the year\nshort\nRules for all the sealed boxes") == "Rules for all the sealed boxes"
    urls = spark.createDataFrame([("EN 1", "spec", "k"), ("EN 1", "spec", None), ("RFC 7515", "ietf", None), ("ITU-T X509", "itu", None), ("OpenID4VCI", "openid", None), ("x", "cen", None)], "r string, s string, k string")
    got = [r[0] for r in urls.select(web.document_url(F.col("r"), F.col("s"), F.col("k"))).collect()]
    assert got[0] == "k" and got[1].endswith("search=EN+1") and got[2].endswith("/rfc7515") and got[3].endswith("T-REC-X.509") and "credential-issuance" in got[4] and got[5] is None


def test_graph_of_reference_sections(spark):
    text = "1 Scope\nNormative references\nEN 319 401, RFC 3161, TS 119 612-2\nInformative references\nRFC 3161, RFC 5280\n3 Terms"
    docs = spark.createDataFrame([("EN 319 401", text), ("x", None)], "id string, text string")
    e = {(r.to_id, r.type) for r in graph.built_edges(docs, "id").collect()}
    assert e == {("RFC 3161", "normative"), ("TS 119 612-2", "normative"), ("RFC 5280", "informative")}
    assert {r.to_id for r in graph.built_edges(docs, "id", spark.createDataFrame([("TS 119 612",)], "ref string")).collect()} == {"TS 119 612-2"}
    assert [tuple(r) for r in graph.reference_counts(graph.section_references(docs, "id"), "id").collect()] == [("EN 319 401", 3, 1, 4)]


def test_stored_index_changes_and_lookups(spark):
    rows = spark.createDataFrame([("a", "Café ῼδή shall"), ("b", "cafe may"), ("c", None)], "id string, text string")
    index = retrieval.stored_index(rows)
    assert {r.id for r in retrieval.bm25(index, "cafe").collect()} == {"a", "b"}
    later = retrieval.with_arrivals(index, spark.createDataFrame([("b", "tea"), ("d", "cafe cafe")], "id string, text string"), spark.createDataFrame([("a",)], "id string"))
    assert {r.id for r in retrieval.bm25(later, "cafe").collect()} == {"d"} and {r.id for r in retrieval.bm25(later, "te*").collect()} == {"b"}
    assert [r.found for r in retrieval.get_segment(rows, "id", "a").collect()] == [True] and tuple(retrieval.get_segment(rows, "id", "z").first()) == (None, None, False)
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<float>")
    assert retrieval.knn_join(v, v.limit(0), 3).count() == 0 and retrieval.knn_join(v.limit(0), v, 3).count() == 0 and retrieval.knn_join(v, v, 9).count() == 2
    found = profiles.ingest_findings(spark.createDataFrame([("f", "N", "v1.1.1", "s", 9), ("g", "g", "vX.X.X", "", 1)], "source_file string, norm string, version string, shortname string, page_count int"), spark.createDataFrame([("f", 1, None, ""), ("f", 2, "x", None)], "source_file string, page int, text string, section string"))
    assert {r.source_file: (r.findings, r.status) for r in found.collect()} == {"f": ("blank pages; little text; few sections", "warn"), "g": ("no version; no norm; no shortname; few pages", "error")}


def test_even_sample_of_a_hot_group(spark):
    df = spark.range(25_003).selectExpr("id AS k", "CASE WHEN id % 5 = 0 THEN 'rare' ELSE 'hot' END AS g")
    got = sorted(r.k for r in sequences.even_sample(df, "g", "k", 4, width=1000).where("g = 'hot'").collect())
    hot = [k for k in range(25_003) if k % 5]
    assert got == hot[:: len(hot) // 4][:4]
