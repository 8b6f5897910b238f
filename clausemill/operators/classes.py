"""Classes of text blocks and word-processor paragraphs, by ordered rules whose thresholds and patterns a profile gives.

Profiles are data: a kind of document has its own zones, sizes, and patterns of headers, footers and boilerplate; what isn't
named has the first profile's. Places are fractions of the page's height from its top, as they are; `inverted` reads them
from the bottom, as some extractors give them.

Defined results: a null text is OTHER; null sizes and boldness count as 0, a null profile as the first; empty tables: nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import MODALS, NUMBER, strip


@dataclass(frozen=True)
class Profile:
    name: str
    header_zone: float
    footer_zone: float
    heading_size: float
    heading_bold: float
    toc_lines: int
    header: tuple[str, ...]
    footer: tuple[str, ...]
    boilerplate: tuple[str, ...]
    size_alone: float = 11.0


# Zones, sizes and wordings of each kind of document, and what the styles of its template stand for.
PROFILES = (
    Profile(
        "etsi-spec", 0.10, 0.09, 11.0, 0.50, 4, (r"ETSI\s+(EN|TS|TR|GS|GR|EG)\s+\d", r"Draft\s+ETSI", r"^ETSI$"),
        (r"^\d+$", r"ETSI\s*$", r"\d{4}-\d{2}$", r"©\s*ETSI", "Publicly Available", "Restricted", "Confidential"),
        (r"^Reference\s*$", r"^Keywords\s*$", r"^ETSI\s+650 Route des Lucioles", "Important Notice", "Intellectual Property Rights", "Essential patents", "No guarantee can be given", "Modal verbs terminology", "In the present document"),
    ),
    Profile("etsi-contribution", 0.12, 0.10, 11.0, 0.50, 3, ("ETSI TC ESI", r"ESI\(\d{2}\)\d+", r"Source:\s+", r"^Meeting\b"), (r"^\d+$", r"©\s*ETSI", "Publicly Available", "Confidential"), ("The present document has been",)),
    Profile("ietf-rfc", 0.06, 0.06, 10.5, 0.40, 4, (r"^RFC\s+\d+", "Internet Engineering Task Force", r"^\[?RFC\d+\]?"), (r"^\[Page \d+\]$", "Internet Standards Track"), ("Status of This Memo", "Copyright Notice", "ISSN:")),
)
STYLES = {
    "OTHER": ("za", "zb", "zt", "zd", "fp"), "INFORM": ("no", "ex", "ew", "editor's note"), "TABLE": ("th", "tf"), "SECTION": ("h6",),
    "NORM": ("b1", "b1+", "b2", "b2+", "b3", "b3+", "b4", "bl", "bn", "pl", "list paragraph"),
}
USUAL = ("intellectual property", "essential patents", "important notice", "modal verbs terminology", "foreword")


def informative(text: Column) -> Column:
    """A note or example by how one of its lines begins, or a part that says that it's informative."""
    return text.rlike(r"(?im)^\s*(note\b|example\b|\[i\.\d+\])") | F.lower(text).contains("(informative)")


def caption(text: Column) -> Column:
    return text.rlike(r"(?i)^(figure|table)\s+[-\da-z]")


def contents_lines(text: Column) -> Column:
    """How many lines end in a page number after at least four dots or blanks."""
    return F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^.{2,60}[. ]{4,}\d{1,4}\s*$")))


def heading_parts(text: Column) -> Column:
    """(num, title) of a numbered heading: a number, then a title with a capital; null for other texts."""
    word, rest = F.regexp_extract(text, r"^(\S+)\s", 1), F.regexp_extract(text, r"^\S+\s+(.*)$", 1)
    ok = (word.rlike(NUMBER) | word.rlike(r"^[A-Z]\.?$")) & rest.rlike(r"^[A-Z]") & F.length(rest).between(3, 81) & ~text.contains("\n")
    return F.when(ok, F.struct(F.rtrim(word, F.lit(".")).alias("num"), strip(rest).alias("title")))


def quick_class(text: Column) -> Column:
    """What the wording alone tells."""
    t = strip(text)
    return F.when(contents_lines(t) >= 1, "TOC").when(informative(t), "INFORM").when(caption(t), "TABLE").when(t.rlike(MODALS), "NORM").otherwise("OTHER")


def _any(text: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | text.rlike(p)
    return out


def block_class(p: Profile, toc_mode: Column, is_heading: Callable[[Column], Column] | None = None, inverted: bool = False) -> Column:
    """Class of a block (text, y_top, y_bot, height, size, bold, page), by the first rule that holds.

    is_heading decides on numbered lines that neither size nor boldness marks; without it they are none.
    """
    t = strip(F.coalesce("text", F.lit("")))
    above, below = F.col("y_top") / F.col("height"), F.col("y_bot") / F.col("height")
    top, bot = (1 - below, 1 - above) if inverted else (above, below)
    size, bold = F.coalesce("size", F.lit(0.0)), F.coalesce("bold", F.lit(0.0))
    later = F.col("page") > 1
    numbered = heading_parts(t).isNotNull()
    marked = ((size >= p.heading_size) & (bold >= p.heading_bold)) | ((size >= p.size_alone) & (bold < p.heading_bold))
    asked = is_heading(t) if is_heading else F.lit(False)
    return (
        F.when((top < p.header_zone) & (_any(t, p.header) | (later & (bot < 1.5 * p.header_zone))), "HEADER")
        .when((bot > 1 - p.footer_zone) & (_any(t, p.footer) | (later & (top > 1 - 1.5 * p.footer_zone))), "FOOTER")
        .when((F.col("page") <= 4) & _any(t, p.boilerplate), "OTHER")
        .when(F.coalesce(toc_mode, F.lit(False)) | (contents_lines(t) >= p.toc_lines), "TOC")
        .when(numbered & (marked | asked), "SECTION")
        .when(informative(t), "INFORM").when(caption(t), "TABLE").when(t.rlike(MODALS), "NORM").otherwise("OTHER")
    )


def by_profile(profile: Column, of: Callable[[Profile], Column], profiles: tuple[Profile, ...] = PROFILES) -> Column:
    """of each profile's value, chosen by name; the first profile's for other names."""
    out = of(profiles[0])
    for p in reversed(profiles[1:]):
        out = F.when(profile == p.name, of(p)).otherwise(out)
    return out


def classified_blocks(blocks: DataFrame, is_heading: Callable[[Column], Column] | None = None, inverted: bool = False) -> DataFrame:
    """blocks (doc, page, profile, text, y_top, y_bot, height, size, bold, toc_mode) with their type."""
    return blocks.withColumn("type", by_profile(F.col("profile"), lambda p: block_class(p, F.col("toc_mode"), is_heading, inverted)))


def style_class(style: Column) -> Column:
    """What a paragraph style stands for in the template; null for styles that it doesn't name."""
    low = F.lower(style)
    out = F.lit(None).cast("string")
    for kind, names in STYLES.items():
        out = F.when(low.isin(*names), kind).otherwise(out)
    return out


def paragraph_class(style: Column, text: Column, bold: Column) -> Column:
    """Class of a word-processor paragraph: its style's, else by what the style is called, else by its wording."""
    t, low = strip(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(style, F.lit("")))
    usual = F.lit(False)
    for u in USUAL:
        usual = usual | F.lower(t).contains(u)
    return (
        F.when(t == "", "OTHER").when(style_class(style).isNotNull(), style_class(style)).when(low.startswith("heading"), "SECTION")
        .when(low.rlike(r"^toc\s") | low.contains("contents"), "TOC").when(usual, "OTHER").when(contents_lines(t) > 0, "TOC").when(informative(t), "INFORM")
        .when((F.coalesce(bold, F.lit(0.0)) >= 0.5) & (F.length(t) < 120) & heading_parts(t).isNotNull(), "SECTION").when(caption(t), "TABLE").when(t.rlike(MODALS), "NORM").otherwise("OTHER")
    )


def carried_sections(paragraphs: DataFrame) -> DataFrame:
    """paragraphs (doc, pos, type, text) with section and section_title: a numbered heading sets both, another only the title."""
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = strip(F.col("text"))
    parts, heads = heading_parts(t), F.col("type") == "SECTION"
    num, title = F.when(heads, parts["num"]), F.when(heads, F.coalesce(parts["title"], t))
    last = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.lit(""))
    return paragraphs.withColumns({"section": last(num), "section_title": last(title)})


def style_audit(paragraphs: DataFrame) -> DataFrame:
    """(style, n, known, sample): every style, whether the template or its name tells what it stands for, and its first text."""
    low = F.lower(F.col("style"))
    known = style_class(F.col("style")).isNotNull() | low.rlike(r"^(heading|toc|header|footer|normal|title|annex|contents)")
    return paragraphs.where("style IS NOT NULL").groupBy("style").agg(F.count("*").alias("n"), F.first(known).alias("known"), F.min_by(F.left("text", F.lit(70)), F.struct("doc", "pos")).alias("sample"))
