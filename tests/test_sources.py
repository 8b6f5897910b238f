import io
import json
import zipfile

from pyspark.sql import functions as F

from clausemill.sources import files, json_docs, markup
from clausemill.streaming import arrivals

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(paragraphs, tables=()):
    p = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r>{"<w:rPr><w:b/></w:rPr>" if b else ""}<w:t>{t}</w:t></w:r></w:p>' for s, t, b in paragraphs)
    t = "".join("<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{c}</w:t></w:r></w:p></w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>" for rows in tables)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{p}{t}</w:body></w:document>")
    return out.getvalue()


def test_files_and_docx(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/A.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "a.docx").write_bytes(docx([("H1", "Scope", True), ("Normal", "It shall.", False)], [[["k", "k", "v"], ["1", "2", "3"]]]))
    (tmp_path / "b.docx").write_bytes(b"no archive")
    (tmp_path / ".hidden.docx").write_bytes(b"x")
    f = files.list_files(spark, str(tmp_path))
    assert {(r.name, r.k) for r in f.select("name", files.sniffed_kind(F.col("content")).alias("k")).collect()} == {("A.pdf", "pdf"), ("a.docx", "docx"), ("b.docx", "unknown")}
    assert {r.name for r in files.prefer_pdf(f).collect()} == {"A.pdf", "b.docx"}
    rows = markup.docx_paragraphs(f.where("name like '%.docx'")).orderBy("doc", "pos").collect()
    assert [(r.doc, r.kind, r.style, r.text, r.bold) for r in rows] == [("a.docx", "p", "H1", "Scope", 1.0), ("a.docx", "p", "Normal", "It shall.", 0.0), ("a.docx", "tbl", None, "k | v\n1 | 2 | 3", 0.0), ("b.docx", "error", None, None, None)]
    assert len(files.crc_manifest(f).where("length(crc) = 8").collect()) == 3


def test_archives(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("small.docx", b"1")
        z.writestr("large.docx", b"22")
        z.writestr("larger.txt", b"333")
    df = spark.createDataFrame([("z", bytearray(out.getvalue())), ("bad", bytearray(b"x"))], "name string, content binary")
    got = {r.name: (r.entry, r.content) for r in markup.largest_docx(df).collect()}
    assert got["z"][0] == "large.docx" and bytes(got["z"][1]) == b"22" and got["bad"] == (None, None)


PAGE = """<html><title>t</title><h1>The Title</h1><p>Intro</p><h2>Normative References</h2><p>RFC 3161</p><h2>Informative References</h2><p>RFC 5280</p>
<a href="/x/pda/1.htm">pda</a><a href="/deliver/en_1.pdf">get</a><script>no</script>
<table><tr><td>EN 1</td><td>A title</td><td>Drafting 2024-05-06</td><td>Approval</td></tr><tr><td>x</td></tr></table> WKI_ID=7 wki_id=7 WKI_ID=8 totalNrItems=12</html>"""


def test_html(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>open")], "page_id int, html string")
    parsed = markup.html_pages(df, "page_id", "html")
    got = {r.key: r for r in parsed.collect()}
    assert got["1"].title == "The Title" and got["1"].normative_text == "RFC 3161" and got["1"].informative_text.startswith("RFC 5280") and "no" not in got["1"].text.split()
    assert got["2"].text == "" and got["3"].text == "open"
    item = markup.work_items(parsed).first()
    assert (item.number, item.current_status.status, str(item.current_status.date), item.next_status.date) == ("EN 1", "Drafting", "2024-05-06", None)
    assert parsed.where("key = '1'").select(markup.delivery_link(F.col("links"))).first()[0] == "/deliver/en_1.pdf"
    assert tuple(df.where("page_id = 1").select(markup.header_fields(F.col("html"))).first()[0]) == (12, 2)


def segment(i, kind="NORM"):
    return {"id": i, "type": kind, "page": 5, "anchor": "#page=5", "section": "5", "section_title": "t", "text": "shall", "normative_keywords": ["shall"], "profile": "p"}


def test_json_and_streaming(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.segments.json").write_text(json.dumps({"norm": "EN 1", "version": "v1.0.0", "segments": [segment("a1", "HEADER"), segment("a2"), segment("a3", "SECTION")]}))
    (inbox / "b.segments.json").write_text(json.dumps({"segments": [segment("b1", "INFORM")]}))
    (tmp_path / "bad.segments.json").write_text("{no json")
    rows = json_docs.segment_files(spark, str(inbox)).orderBy("id").collect()
    assert [(r.id, r.norm, r.version, r.pos) for r in rows] == [("a1", "EN 1", "v1.0.0", 0), ("a2", "EN 1", "v1.0.0", 1), ("a3", "EN 1", "v1.0.0", 2), ("b1", "b", "", 0)]
    assert [r.pos for r in json_docs.segment_files(spark, str(tmp_path / "bad.segments.json")).collect()] == [None]
    where = (str(inbox), str(tmp_path / "table"), str(tmp_path / "check"))
    arrivals.index_arrivals(spark, *where)
    arrivals.index_arrivals(spark, *where)
    ids = lambda: sorted(r.id for r in arrivals.current(spark, where[1]).collect())
    assert ids() == ["a2", "a3", "b1"]
    (inbox / "c.segments.json").write_text(json.dumps({"norm": "EN 3", "segments": [segment("c1"), segment("c1")]}))
    arrivals.index_arrivals(spark, *where)
    assert ids() == ["a2", "a3", "b1", "c1"]


def test_rules_titles_resources(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"stem": "x", "gap_threshold": 18, "merge_endings": [";"]}]))
    stems = spark.createDataFrame([("x",), ("y",)], "stem string")
    assert {r.stem: (r.gap_threshold, r.merge_endings) for r in json_docs.rules(spark, str(tmp_path / "r.json"), stems).collect()} == {"x": (18, [";"]), "y": (20, [])}
    (tmp_path / "t1.json").write_text(json.dumps({"etsiNumber": "EN 319 401", "shortTitle": "One"}))
    (tmp_path / "t2.json").write_text(json.dumps({"etsiNumber": "EN319401", "shortTitle": "Two"}))
    assert [(r.key, r.shortTitle) for r in json_docs.titles(spark, str(tmp_path / "t*.json")).collect()] == [("EN319401", "Two")]
    (tmp_path / "o1.json").write_text(json.dumps({"id": "r1"}))
    (tmp_path / "o2.json").write_text(json.dumps({"label": "none"}))
    good, bad = json_docs.resources(spark, str(tmp_path / "o*.json"))
    assert good.count() == 1 and bad.count() == 1
