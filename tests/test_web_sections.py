import numpy as np
import pytest
from pyspark.sql import functions as F

from clausemill.functions import embedding, web
from clausemill.operators import classes, sections


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (web.work_item_id, "http://x/?WKI_ID=123&a=1", "123"), (web.work_item_id, "http://x/", None),
        (web.clean_url, "http://x/p?a=1&b=&c", "http://x/p?a=1"), (web.clean_url, "http://x/p?b=", "http://x/p"),
        (web.url_class, "http://x/deliver/a.pdf", "delivery"), (web.url_class, "http://docbox.x/a", "docbox"), (web.url_class, "http://x/", "portal"),
        (web.safe_name, "EN 319/401: x", "EN_319_401_x"),
        (web.short_title, "<think>hm\n</think>\n- \"Trust Service Policy Requirements Extra\"\nmore", "Trust Service Policy Requirements"),
        (web.short_title, "one two three four five six seven eight nine", None), (web.short_title, "", None),
        (lambda c: web.size_text(F.length(c)), "x" * 2048, "2.0 KB"),
    ],
)
def test_fetch_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_fetch_decisions(spark):
    rows = [(False, False, False, True, "same", "download"), (True, True, False, True, "same", "download"), (True, False, True, False, "changed", "report-changed"), (True, False, True, False, "same", "skip"), (True, False, False, True, "changed", "skip"), (True, False, False, False, "same", "refresh"), (True, False, False, False, "unknown", "download")]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean, d boolean, s string, want string")
    assert all(r.x == r.want for r in df.select(web.fetch_action(*map(F.col, "abcds")).alias("x"), "want").collect())
    sizes = spark.createDataFrame([(25_000, 5), (10, 5), (None, 0)], "d long, p long")
    assert [r[0] for r in sizes.select(web.format_choice(F.col("d"), F.col("p"))).collect()] == ["docx", "pdf", "unknown"]
    assert [r[0] for r in spark.createDataFrame([(5, 5), (2000, 2000), (None, 2000), (1, 2000)], "a long, b long").select(web.intact(F.col("a"), F.col("b"))).collect()] == [False, True, True, False]


def test_sections_on_pages(spark):
    s = spark.createDataFrame([("d#1", "d", 1, 2, "abc"), ("d#2", "d", 2, 2, "x" * 20), ("d#3", "d", 5, 4, "never"), ("e#1", "e", 9, 9, None)], "id string, doc string, page_from int, page_to int, text string")
    p = spark.createDataFrame([("d", 1, "aaaa"), ("d", 2, "bb"), ("d", 2, "cccc"), ("d", 3, "zz")], "doc string, page int, text string")
    covered = sections.pages_in_sections(s, p)
    assert {r.id: (r.n, r.chars) for r in covered.collect()} == {"d#1": (3, 10), "d#2": (2, 6)}
    assert [(r.extracted, r.available, r.ratio, r.low) for r in sections.coverage(covered, s).collect()] == [(23, 16, 1.438, False)]


def test_classes(spark):
    rows = [("Heading 1", "Scope", 0.0, "SECTION"), ("TOC 2", "5 x", 0.0, "TOC"), ("NO", "x", 0.0, "INFORM"), (None, "NOTE: x", 0.0, "INFORM"), (None, "5.1 Bold", 1.0, "SECTION"), ("TH", "x", 0.0, "TABLE"), ("Normal", "It shall.", 0.0, "NORM"), ("Normal", "plain", 0.0, "OTHER"), (None, " ", 0.0, "OTHER")]
    df = spark.createDataFrame(rows, "s string, t string, b double, want string")
    assert all(r.x == r.want for r in df.select(classes.paragraph_class(F.col("s"), F.col("t"), F.col("b")).alias("x"), "want").collect())
    toc = spark.createDataFrame([("Foreword", None, "boilerplate"), ("Forms", "A.1", "annex"), ("Method (informative)", "7", "inform"), ("Scope", "1", "norm")], "t string, n string, want string")
    assert all(r.x == r.want for r in toc.select(sections.section_class(F.col("t"), F.col("n")).alias("x"), "want").collect())


def test_embeddings_are_repeatable_and_of_unit_length(spark):
    df = spark.createDataFrame([(1, "NORM", "shall keep logs", 0), (2, "NORM", "shall keep logs", None), (3, "INFORM", " ", 0), (4, "NORM", "done", 1), (5, "TOC", "x", 0), (6, "NORM", None, 0)], "row_nr long, type string, text string, has_embedding int")
    out = {r.row_nr: r.embedding for r in embedding.embed_missing(df).collect()}
    assert set(out) == {1, 2} and out[1] == out[2] and np.linalg.norm(out[1]) == pytest.approx(1, abs=1e-6)
