"""Word-processor, HTML and plain-text sources, parsed once a file in Arrow batches; only bounded rows leave."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
PARAGRAPHS = "doc string, pos int, kind string, style string, text string, bold double, rows array<array<string>>"


def _docx_rows(name: str, content: bytes) -> list[tuple]:
    try:
        body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))[0]
    except (zipfile.BadZipFile, KeyError, IndexError, ElementTree.ParseError):
        return [(name, 0, "error", None, None, None, None)]
    out = []
    text_of = lambda e: "".join(t.text or "" for t in e.iter(_W + "t"))
    for pos, e in enumerate(body):
        if e.tag == _W + "p":
            style = e.find(f"{_W}pPr/{_W}pStyle")
            runs = [r for r in e.iter(_W + "r") if text_of(r)]
            bold = sum(r.find(f"{_W}rPr/{_W}b") is not None for r in runs) / len(runs) if runs else 0.0
            out.append((name, pos, "p", style.get(_W + "val") if style is not None else None, text_of(e), bold, None))
        elif e.tag == _W + "tbl":
            rows = [[text_of(c) for c in r.findall(_W + "tc")] for r in e.findall(_W + "tr")]
            flat = "\n".join(" | ".join(c for k, c in enumerate(r) if not k or c != r[k - 1]) for r in rows)
            out.append((name, pos, "tbl", None, flat, 0.0, rows))
    return out


def docx_paragraphs(files: DataFrame) -> DataFrame:
    """Paragraphs and tables of word-processor files (name, content), in body order; unreadable files give an error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in PARAGRAPHS.split(", ")]
        for b in batches:
            yield pd.DataFrame([r for n, c in zip(b["name"], b["content"]) for r in _docx_rows(n, bytes(c))], columns=cols)

    return files.select("name", "content").mapInPandas(run, PARAGRAPHS)


def largest_docx(files: DataFrame) -> DataFrame:
    """(name, entry, content) of the largest word-processor entry of each archive; both null for an unreadable archive."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for n, c in zip(b["name"], b["content"]):
                try:
                    z = zipfile.ZipFile(io.BytesIO(bytes(c)))
                except zipfile.BadZipFile:
                    got.append((n, None, None))
                    continue
                found = [i for i in z.infolist() if i.filename.lower().endswith(".docx")]
                if found:
                    best = max(found, key=lambda i: (i.file_size, i.filename))
                    got.append((n, best.filename, z.read(best)))
            yield pd.DataFrame(got, columns=["name", "entry", "content"])

    return files.select("name", "content").mapInPandas(run, "name string, entry string, content binary")


class _Page(HTMLParser):
    """Text blocks with their tag, links, table rows, and what lies in informative parts."""

    def __init__(self) -> None:
        super().__init__()
        self.blocks: list[list[str]] = []
        self.links: list[tuple[str, str]] = []
        self.rows: list[list[str]] = []
        self.skip = 0
        self.href: str | None = None
        self.cell = False

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag in ("h1", "h2", "h3", "h4", "p", "li", "dt", "dd", "div", "section", "title", "br"):
            self.blocks.append([tag, ""])
        if tag == "a":
            self.href = dict(attrs).get("href")
            if self.href:
                self.links.append((self.href, ""))
        if tag == "tr":
            self.rows.append([])
        if tag in ("td", "th") and self.rows:
            self.rows[-1].append("")
            self.cell = True

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        if tag == "a":
            self.href = None
        if tag in ("td", "th", "tr", "table"):
            self.cell = False

    def handle_data(self, data):
        if self.skip:
            return
        if not self.blocks:
            self.blocks.append(["body", ""])
        self.blocks[-1][1] += data
        if self.href and self.links:
            self.links[-1] = (self.links[-1][0], self.links[-1][1] + data)
        if self.cell and self.rows and self.rows[-1]:
            self.rows[-1][-1] += data


HTML = "key string, title string, text string, normative_text string, informative_text string, links array<struct<href:string,label:string>>, rows array<array<string>>"


def _parsed(key: str, html: str | None) -> tuple:
    p = _Page()
    p.feed(html or "")
    squeeze = lambda s: re.sub(r"\s+", " ", s).strip()
    blocks = [(t, squeeze(x)) for t, x in p.blocks if squeeze(x)]
    title = next((x for t, x in blocks if t == "h1"), next((x for t, x in blocks if t == "title"), None))
    parts: dict[str, list[str]] = {"n": [], "i": [], "": []}
    at = ""
    for t, x in blocks:
        if t in ("h1", "h2", "h3", "h4"):
            low = x.lower()
            at = "n" if "normative reference" in low and "informative" not in low else "i" if "informative reference" in low else ""
        else:
            parts[at].append(x)
    return key, title, "\n".join(x for _, x in blocks), "\n".join(parts["n"]), "\n".join(parts["i"]), p.links, [[squeeze(c) for c in r] for r in p.rows if r]


def html_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Title, text, reference sections, links and table rows of each page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["key", "title", "text", "normative_text", "informative_text", "links", "rows"]
        for b in batches:
            got = [_parsed(k, h) for k, h in zip(b["key"], b["html"])]
            yield pd.DataFrame([(*g[:5], [{"href": a, "label": t.strip()} for a, t in g[5]], g[6]) for g in got], columns=cols)

    return pages.select(F.col(key).cast("string").alias("key"), F.col(html).alias("html")).mapInPandas(run, HTML)


def work_items(parsed: DataFrame) -> DataFrame:
    """Rows of four cells as work items: number, reference and title, current and next status with their dates."""
    r = parsed.select("key", F.posexplode("rows").alias("pos", "c")).where(F.size("c") == 4)
    status = lambda c: F.struct(F.trim(F.regexp_replace(c, r"\(?\d{4}-\d{2}-\d{2}\)?", "")).alias("status"), F.expr("try_to_date(nullif(regexp_extract(x, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''))".replace("x,", f"{c},")).alias("date"))
    flat = r.select("key", "pos", *[F.col("c")[i].alias(f"c{i}") for i in range(4)])
    return flat.select("key", "pos", F.col("c0").alias("number"), F.col("c1").alias("title"), status("c2").alias("current_status"), status("c3").alias("next_status"))


def delivery_link(links: Column) -> Column:
    """The best link of a detail page: a delivery, a public area, any PDF or archive, the archive, in this order."""
    first = lambda p: F.try_element_at(F.filter(F.transform(links, lambda x: x["href"]), lambda h: h.rlike(p)), F.lit(1))
    return F.coalesce(*[first(p) for p in (r"(?i)/deliver/.*\.pdf$", r"(?i)/pda/", r"(?i)\.(pdf|zip)$", r"(?i)docbox")])


def plain_references(text: Column) -> Column:
    """(title, normative, informative) of a plain-text standard."""
    part = lambda name, end: F.regexp_extract(text, rf"(?ims)^\s*\d*(?:\.\d+)*\.?\s*{name} references\s*$(.*?)(?:{end}|\z)", 1)
    lines = F.filter(F.transform(F.split(text, "\n"), F.trim), lambda x: F.length(x) > 20)
    return F.struct(F.try_element_at(lines, F.lit(1)).alias("title"), part("normative", r"^\s*\d*(?:\.\d+)*\.?\s*informative references\s*$").alias("normative"), part("informative", r"^\s*(?:Appendix|Authors?'? Address)").alias("informative"))


def header_fields(html: Column) -> Column:
    """(total, items) of a list page: the stated number of items and how many it links."""
    return F.struct(F.expr("try_cast(regexp_extract(html, 'totalNrItems=([0-9]+)', 1) AS int)").alias("total"), F.size(F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)WKI_ID=(\d+)"), F.lit(1)))).alias("items"))


class _Tables(HTMLParser):
    """Rows of cells by table; a cell is its parts between line breaks, each with its text and what of it is grey."""

    GREY = ("708090", "slategray", "slategrey")

    def __init__(self) -> None:
        super().__init__()
        self.tables: list[list[list[list[list[str]]]]] = []
        self.open: list[int] = []
        self.grey: list[bool] = []

    def _row(self) -> list | None:
        return self.tables[self.open[-1]][-1] if self.open and self.tables[self.open[-1]] else None

    def handle_starttag(self, tag, attrs):
        row = self._row()
        if tag == "table":
            self.tables.append([])
            self.open.append(len(self.tables) - 1)
        elif tag == "tr" and self.open:
            self.tables[self.open[-1]].append([])
        elif tag in ("td", "th") and row is not None:
            row.append([["", ""]])
        elif tag == "br" and row:
            row[-1].append(["", ""])
        elif tag == "font":
            self.grey.append((dict(attrs).get("color") or "").lower().lstrip("#") in self.GREY)

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()
        elif tag == "font" and self.grey:
            self.grey.pop()

    def handle_data(self, data):
        row = self._row()
        if row:
            row[-1][-1][0] += data
            row[-1][-1][1] += data if any(self.grey) else ""


def _squeeze(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table, pos, cells, parts): every table row of each page; parts has, for each cell, the (text, grey) of its lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for k, h in zip(b["key"], b["html"]):
                p = _Tables()
                p.feed(h or "")
                for t, rows in enumerate(p.tables):
                    for i, row in enumerate(rows):
                        parts = [[{"text": _squeeze(x), "grey": _squeeze(g)} for x, g in cell] for cell in row]
                        got.append((k, t, i, [_squeeze(" ".join(x["text"] for x in c)) for c in parts], parts))
            yield pd.DataFrame(got, columns=["key", "table", "pos", "cells", "parts"])

    schema = "key string, table int, pos int, cells array<string>, parts array<array<struct<text:string,grey:string>>>"
    return pages.select(F.col(key).cast("string").alias("key"), F.col(html).alias("html")).mapInPandas(run, schema)


def milestones(tables: DataFrame) -> DataFrame:
    """(key, pos, milestone, target, achieved) of the tables whose first row names a milestone and an achieved or actual column."""
    head = tables.where("pos = 0").select("key", "table", F.transform("cells", F.lower).alias("h"))
    at = lambda words: F.array_position(F.transform("h", lambda c: F.coalesce(c.rlike(words), F.lit(False))), True).cast("int")
    cols = head.select("key", "table", at("milestone").alias("m"), at("target|planned").alias("t"), at("achieved|actual").alias("a")).where("m > 0 AND a > 0")
    rows = tables.where("pos > 0").join(cols, ["key", "table"])
    cell = lambda i: F.when(F.col(i) > 0, F.try_element_at("cells", F.col(i)))
    given = lambda c: F.when(~F.coalesce(c, F.lit("")).isin("", "-"), c)
    out = rows.select("key", F.struct("table", "pos").alias("pos"), cell("m").alias("milestone"), given(cell("t")).alias("target"), given(cell("a")).alias("achieved"))
    return out.where("milestone <> ''")


def schedules(tables: DataFrame) -> DataFrame:
    """The rows of each page's last table that speaks of milestones, stages or targets."""
    said = F.array_contains(F.transform("cells", lambda c: F.lower(c).rlike("milestone|stage|target")), True)
    last = tables.where(said).groupBy("key").agg(F.max("table").alias("table"))
    return tables.join(last, ["key", "table"], "left_semi")


def labelled_titles(tables: DataFrame) -> DataFrame:
    """(key, full_title, short_title): what stands beside the first cell that says 'Title'.

    Its first line is the full title; of the second, the grey text is the short one, else the line if it's long enough. A
    title that merely says 'Title 1' is none.
    """
    at = F.array_position(F.transform("cells", lambda c: F.lower(c) == "title"), True).cast("int")
    hit = tables.withColumn("at", at).where((F.col("at") > 0) & (F.col("at") < F.size("cells")))
    first = hit.groupBy("key").agg(F.min_by(F.element_at("parts", F.col("at") + 1), F.struct("table", "pos")).alias("p"))
    real = lambda c: F.when((c != "") & ~c.rlike(r"(?i)^(title\s*\d+\s*)+$"), c)
    one, two = F.try_element_at("p", F.lit(1)), F.try_element_at("p", F.lit(2))
    return first.select("key", real(one["text"]).alias("full_title"), F.coalesce(real(two["grey"]), F.when(F.length(two["text"]) > 8, real(two["text"]))).alias("short_title"))


def stopped(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, stopped): whether a page says that its item was stopped."""
    return pages.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(html).rlike(r"\bSTOPPED\b"), F.lit(False)).alias("stopped"))


def cover_title(lines: Column) -> Column:
    """A cover page's title: the first line of more than 20 characters that isn't a number, a version or a notice."""
    good = F.filter(F.transform(lines, F.trim), lambda x: (F.length(x) > 20) & ~x.rlike(r"(?i)^(etsi|draft|\d|version|release|©)"))
    return F.try_element_at(good, F.lit(1))
