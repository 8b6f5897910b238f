"""Text functions of the segment pipeline, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modal verbs, longest first; placeholders.
MODALS = r"(?i)\b(shall\s+not|shall|should\s+not|should|must\s+not|must|required|recommended|may\s+not|may|optional)\b"
PLACEHOLDERS = ((r"\b\d{4}-\d{2}-\d{2}\b", "<DATE>"), (r"\b\d+\b", "<N>"), (r"(?i)v\d+\.\d+\.\d+", "<VER>"), (r"\s+", " "))
# Titles that every document has, as they stand in tables of contents without a number.
UNNUMBERED = ("intellectual property rights", "foreword", "introduction", "history", "modal verbs terminology")
#: A clause number as the first word of a line: an annex letter or none, then numbers with dots.
NUMBER = r"^[A-Z]?\.?\d+(\.\d+)*\.?$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_text(c: Column) -> Column:
    """Control characters to spaces, at most one blank line in a row, no trailing blanks."""
    c = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")
    return strip(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"(?m)[ \t]+$", ""))


def normative_keywords(c: Column) -> Column:
    """The distinct modal verbs of a text, lower-cased, sorted."""
    found = F.transform(F.regexp_extract_all(c, F.lit(MODALS), F.lit(1)), lambda w: F.regexp_replace(F.lower(w), r"\s+", " "))
    return F.array_sort(F.array_distinct(found))


def cross_references(c: Column) -> Column:
    """The distinct numbers that follow the words clause, section and annex, sorted."""
    after = F.regexp_extract_all(c, F.lit(r"(?i)\b(clause|section|annex)\s+([a-z]?\d[\d.]*)"), F.lit(2))
    return F.array_sort(F.array_distinct(F.transform(after, lambda n: F.rtrim(n, F.lit(".")))))


def placeholders(c: Column) -> Column:
    """Dates, numbers and versions replaced by their kind."""
    c = strip(c)
    for pattern, name in PLACEHOLDERS:
        c = F.regexp_replace(c, pattern, name)
    return c


def is_boilerplate(c: Column) -> Column:
    """Whether a text carries no content: very short, a mere number or leader, or page furniture by how it begins."""
    t = strip(c)
    low = F.lower(t)
    only = lambda chars: F.translate(t, chars, "") == ""
    furniture = low.rlike(r"^etsi\s") | low.rlike(r"draft\s+en") | F.left(t, F.lit(9)).isin("Copyright", "copyright") | F.left(t, F.lit(17)).isin("Table of contents", "Table of Contents")
    leader = F.startswith(t, F.lit("..")) & F.ltrim(F.ltrim(t, F.lit(".")), F.lit(" \t")).rlike(r"^\d+$")
    return (F.length(t) < 5) | only("0123456789") | only("IVX") | furniture | leader


def word_set(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "), " "), lambda w: w != ""))


def word_jaccard(a: Column, b: Column) -> Column:
    x, y = word_set(a), word_set(b)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))


def snippet(c: Column, pattern: str, context: int = 1) -> Column:
    """The lines around the first line that has a match, which is marked."""
    lines = F.split(c, "\n")
    at = F.array_position(F.transform(lines, lambda x: F.regexp_like(x, F.lit("(?i)" + pattern))), True).cast("int")
    marked = F.transform(lines, lambda x, i: F.when(i + 1 == at, F.concat(F.lit(">>> "), x)).otherwise(x))
    first = F.greatest(at - context, F.lit(1))
    return F.when(at > 0, F.array_join(F.slice(marked, first, at - first + 1 + context), "\n"))


def doubled_ratio(c: Column) -> Column:
    """How much of a text's words look as if every letter had been printed twice."""
    words = F.regexp_extract_all(c, F.lit(r"\b([A-Za-z]{4,})\b"), F.lit(1))
    strong = F.size(F.filter(words, lambda w: w.rlike(r"^(?:([A-Za-z])\1){2,}")))
    weak = F.size(F.filter(words, lambda w: w.rlike(r"([A-Za-z])\1[A-Za-z]?([A-Za-z])\2") & ~w.rlike(r"^(?:([A-Za-z])\1){2,}")))
    return (strong + 0.35 * weak) / F.greatest(F.size(words), F.lit(1))


def undouble(c: Column) -> Column:
    """Words of four or more doubled letters read singly; other doubled letters stay."""
    tokens = F.regexp_extract_all(c, F.lit(r"(\w+|\W+)"), F.lit(1))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^(?:([A-Za-z])\1){4,}$"), F.regexp_replace(t, r"(.)\1", "$1")).otherwise(t)), "")


def toc_entry(line: Column) -> Column:
    """(num, title, page, annex_type, form) of a line of a table of contents; null for other lines.

    A line is read from its end: the page number, the leader of dots and blanks before it, and the head, whose first word
    may be a clause number. Forms, in this order: leader, annex, unnumbered, loose (blanks only, at least two on either
    side of the title).
    """
    let = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  each part is worked out once
    tail = F.regexp_extract(strip(line), r"([.\s]*)(\d+)$", 0)
    ends = F.struct(strip(line).alias("s"), F.length(tail).alias("n"), F.regexp_extract(tail, r"(\d+)$", 1).alias("page"))

    def split_head(e: Column) -> Column:
        head = F.left(e["s"], F.length(e["s"]) - e["n"])
        parts = F.struct(head.alias("head"), F.left(F.right(e["s"], e["n"]), e["n"] - F.length(e["page"])).alias("leader"), e["page"].alias("page"), F.regexp_extract(head, r"^(\S+)", 1).alias("word"), F.regexp_extract(head, r"^\S+(\s*)", 1).alias("gap"))
        return F.when(F.length(e["page"]).between(1, 4), let(parts, read))

    def read(p: Column) -> Column:
        title, word = F.substr(p["head"], F.length(p["word"]) + F.length(p["gap"]) + 1), F.rtrim(p["word"], F.lit("."))
        numbered, size, far, gap = p["word"].rlike(NUMBER), F.length(title), F.length(p["leader"]), F.length(p["gap"])
        annex = r"(?i)^annex\s+([a-z])\s*\((normative|informative)\)[:\s]*(.*)$"
        form = (
            F.when(numbered & (far >= 3) & (gap <= 6) & size.between(2, 80), "leader").when(p["head"].rlike(annex), "annex")
            .when(F.lower(p["head"]).isin(*UNNUMBERED) & (far >= 3), "unnumbered")
            .when(numbered & (gap >= 2) & (far >= 2) & ~p["leader"].contains(".") & size.between(2, 60), "loose")
        )
        lettered = F.concat(F.lit("Annex "), F.upper(F.regexp_extract(p["head"], annex, 1)))
        return let(F.struct(form.alias("form"), title.alias("title"), word.alias("word")), lambda f: F.when(f["form"].isNotNull(), F.struct(
            F.when(f["form"] == "annex", lettered).when(f["form"] == "unnumbered", "").otherwise(f["word"]).alias("num"),
            F.when(f["form"] == "annex", F.regexp_extract(p["head"], annex, 3)).when(f["form"] == "unnumbered", p["head"]).otherwise(f["title"]).alias("title"),
            p["page"].cast("int").alias("page"), F.when(f["form"] == "annex", F.lower(F.regexp_extract(p["head"], annex, 2))).alias("annex_type"), f["form"].alias("form"),
        )))

    return F.when(line.rlike(r"\d\s*$"), let(ends, split_head))


def headings(c: Column) -> Column:
    """The numbers of a text's heading lines: a clause number, then a title that begins with a capital."""
    parts = F.transform(F.split(c, "\n"), lambda x: F.struct(F.regexp_extract(x, r"^(\S+)\s", 1).alias("num"), F.regexp_extract(x, r"^\S+\s+(.*)$", 1).alias("title")))
    is_number = lambda n: n.rlike(r"^[A-Z]?\.?(\d+\.)+\d*$") | n.rlike(r"^\.?\d+$")
    return F.transform(F.filter(parts, lambda p: is_number(p["num"]) & p["title"].rlike(r"^[A-Z]") & F.length(p["title"]).between(3, 81)), lambda p: p["num"])


def stitched(pages: Column) -> Column:
    """Page texts as one: a page break within a sentence becomes a space, any other stays as a form feed."""
    return F.regexp_replace(F.array_join(pages, "\f"), r"([^.!?:\n])\f([a-z])", "$1 $2")


def table_markdown(rows: Column) -> Column:
    """An array of rows as a Markdown table, each row cut or padded to the header's width."""
    width = F.size(rows[0])
    cells = lambda r: F.transform(
        F.sequence(F.lit(1), width), lambda i: F.replace(F.coalesce(F.try_element_at(r, i), F.lit("")), F.lit("|"), F.lit("\\|"))
    )
    line = lambda r: F.concat(F.lit("| "), F.array_join(cells(r), " | "), F.lit(" |"))
    full = F.filter(F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.array_join(F.concat(F.array(line(rows[0]), rule), F.transform(full, line)), "\n")


def crc32_hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.crc32(c))), 8, "0")


def shortened(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - 3)), F.lit("..."))).otherwise(c)


def figure_captions(c: Column) -> Column:
    """(kind, number, title) of the lines that caption a figure or a table."""
    p = r"(?i)^\s*(figure|table)\s+([a-z]?\.?\d[\d.]*)\s*[:.–-]\s*(\S.*)$"
    lines = F.filter(F.split(c, "\n"), lambda x: x.rlike(p))
    return F.transform(lines, lambda x: F.struct(F.lower(F.regexp_extract(x, p, 1)).alias("kind"), F.rtrim(F.regexp_extract(x, p, 2), F.lit(".")).alias("number"), strip(F.regexp_extract(x, p, 3)).alias("title")))


def decoded_list(c: Column) -> Column:
    """A JSON list of strings; a text that is none is a list of that text, a null or empty one an empty list."""
    got = F.from_json(c, "array<string>")
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.coalesce(got, F.array(c)))


def escaped_markdown(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
