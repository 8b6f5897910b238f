import pytest
from pyspark.sql import functions as F

from clausemill.functions import identifiers as I
from clausemill.functions import text as T


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    ("name", "norm", "version"),
    [
        ("ts_119403v020201p.pdf", "TS 119 403", "v2.2.1"), ("ts_11913201v010001p.pdf", "TS 119 132 01", "v1.0.1"), ("EN_319_401_v2.2.1.pdf", "EN 319 401", "v2.2.1"),
        ("ESI-0019102-1v151v142.docx", "EN 319 102-1", "v1.5.1"), ("ESI-0019060v002", "EN 319 060", "v0.0.2"), ("anything.pdf", "anything", "vX.X.X"),
    ],
)
def test_file_names(spark, name, norm, version):
    assert (one(spark, name, I.file_norm), one(spark, name, I.file_version)) == (norm, version)


def test_keys(spark):
    assert one(spark, "EN 319-401", I.loose_key) == "en319401"
    assert one(spark, "ts119 132-1", I.normalized_ref) == "TS 119 132-1"
    assert one(spark, "TS 119 132 01", I.canonical_norm) == "TS 119 132-1"
    assert one(spark, "v1.10.2", I.version_key) == (1, 10, 2) and one(spark, "draft", I.version_key) is None
    assert one(spark, "5.1.2", I.section_depth) == 3


def test_text_functions(spark):
    assert one(spark, "It SHALL  not and may; shall.", T.normative_keywords) == ["may", "shall", "shall not"]
    assert one(spark, "see clause 5.1 and Annex B2, section 5.1", T.cross_references) == ["5.1", "B2"]
    assert one(spark, "on 2024-01-02 item 7 of v1.2.3", T.placeholders).startswith("on <DATE> item <N>")
    assert one(spark, "17", T.is_boilerplate) and not one(spark, "A sentence.", T.is_boilerplate)
    assert one(spark, "CCoommmmiitttteeee Committee", T.undouble) == "Committee Committee"
    assert one(spark, "a\nthe key here\nb\nc", lambda c: T.snippet(c, "KEY")) == "a\n>>> the key here\nb"
    assert tuple(one(spark, "5.3  General requirements ......... 42", T.toc_entry)) == ("5.3", "General requirements", 42, None, "leader")
    assert tuple(one(spark, "Annex A (normative):  Forms ......... 55", T.toc_entry)) == ("Annex A", "Forms", 55, "normative", "annex")
    assert tuple(one(spark, "Foreword ....... 5", T.toc_entry)) == ("", "Foreword", 5, None, "unnumbered")
    assert tuple(one(spark, "7  Records  12", T.toc_entry)) == ("7", "Records", 12, None, "loose")
    assert one(spark, "7 records 12", T.toc_entry) is None and one(spark, "5 Title ..... 12345", T.toc_entry) is None
    assert one(spark, "4.1 Scope\nno 5 Heading\n6 General\n7 x", T.headings) == ["4.1", "6"]
    assert one(spark, "abc", T.crc32_hex) == "352441c2"
    assert one(spark, None, T.normative_keywords) is None


def test_tables_and_pages(spark):
    df = spark.createDataFrame([([["a", "b"], ["1", "2|3"], ["", ""], ["4"]], ["ends here", "and goes on.", "New"])], "rows array<array<string>>, pages array<string>")
    r = df.select(T.table_markdown(F.col("rows")).alias("m"), T.stitched(F.col("pages")).alias("s")).first()
    assert r.m == "| a | b |\n| --- | --- |\n| 1 | 2\\|3 |\n| 4 |  |"
    assert r.s == "ends here and goes on.\fNew"
