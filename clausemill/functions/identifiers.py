"""Document identifiers: file names, archive keys, and the loose keys they are matched by. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The file-name forms in use, tried in this order.
SHORT = r"(?i)^([a-z]+)_(\d{3})(\d{3,4})v(\d{2})(\d{2})(\d{2})p\.pdf$"
LONG = r"(?i)^([a-z]+)_(\d{3})(\d{3})(\d{2})v(\d{2})(\d{2})(\d{2})p\.pdf$"
MANUAL = r"(?i)^([A-Z]+_\d+_\d+(?:_\d+)?)_(v[\d.]+)\.pdf$"
ARCHIVE = r"(?i)^ESI-(\d{7})(?:-(\d+))?v(\d{3})(?:v\d{3})?(?:\.(?:pdf|docx))?$"
PLACEHOLDER_VERSION = "vX.X.X"
ARCHIVE_OFFSET = 300000


def _g(c: Column, pattern: str, i: int) -> Column:
    return F.regexp_extract(c, pattern, i)


def _number(c: Column) -> Column:
    return c.cast("int").cast("string")


def archive_norm(number: Column, part: Column) -> Column:
    """Standard of an archive number: 0019401 is EN 319 401; series from 300 are EN, others TS."""
    full = number.cast("int") + ARCHIVE_OFFSET
    series = F.floor(full / 1000).cast("int")
    base = F.format_string("%s %d %03d", F.when(series >= 300, "EN").otherwise("TS"), series, full % 1000)
    return F.when(F.coalesce(part, F.lit("")) != "", F.concat(base, F.lit("-"), part)).otherwise(base)


def _dotted(digits: Column) -> Column:
    return F.concat(F.lit("v"), F.array_join(F.transform(F.split(digits, ""), lambda d: d), "."))


def file_norm(name: Column) -> Column:
    """The standard a file name stands for; the bare stem if it has no known form."""
    return (
        F.when(name.rlike(SHORT), F.concat_ws(" ", F.upper(_g(name, SHORT, 1)), _g(name, SHORT, 2), _g(name, SHORT, 3)))
        .when(name.rlike(LONG), F.concat_ws(" ", F.upper(_g(name, LONG, 1)), _g(name, LONG, 2), _g(name, LONG, 3), _g(name, LONG, 4)))
        .when(name.rlike(MANUAL), F.translate(_g(name, MANUAL, 1), "_", " "))
        .when(name.rlike(ARCHIVE), archive_norm(_g(name, ARCHIVE, 1), _g(name, ARCHIVE, 2)))
        .otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))
    )


def file_version(name: Column) -> Column:
    pair = lambda p, i: F.concat(F.lit("v"), F.concat_ws(".", *[_number(_g(name, p, k)) for k in (i, i + 1, i + 2)]))
    return (
        F.when(name.rlike(SHORT), pair(SHORT, 4))
        .when(name.rlike(LONG), pair(LONG, 5))
        .when(name.rlike(MANUAL), F.lower(_g(name, MANUAL, 2)))
        .when(name.rlike(ARCHIVE), _dotted(_g(name, ARCHIVE, 3)))
        .otherwise(F.lit(PLACEHOLDER_VERSION))
    )


def archive_key(norm: Column) -> Column:
    """The standard that an archive key with a version stands for; null for other names."""
    p = r"(?i)^ESI-00(\d{5})(?:-(\d+))?v"
    return F.when(norm.rlike(p), archive_norm(_g(norm, p, 1), _g(norm, p, 2)))


def archive_key_version(norm: Column) -> Column:
    """The version of an archive key: the digits after its first v, one a field if there are two or three of them.

    A key with a second v may end after two fields, one with a single v has three; longer runs are one field.
    """
    first, more = _g(norm, r"(?i)^ESI-\d{7}(?:-\d+)?v(\d+)", 1), norm.rlike(r"(?i)^ESI-\d{7}(?:-\d+)?v\d+v\d+(?:v\d+)?$")
    n = F.length(first)
    single = norm.rlike(r"(?i)^ESI-\d{7}(?:-\d+)?v\d+$")
    return F.when((more & n.isin(2, 3)) | (single & (n == 3)), _dotted(first)).when(more | single, F.concat(F.lit("v"), first))


def docx_doc_id(name: Column) -> Column:
    """Contribution files read an archive number 19472 as 119 472, a TS; other names by their type and digits; null without."""
    archive, typed = r"(?i)ESI-00(\d\d)(\d{3})-?(\d)?", r"(?i)(TS|TR|EN|ES)[\s_-]*(\d{3})[\s_-]*(\d{3})(?:[\s_-]*(\d+))?"
    part = lambda p, i: F.when(_g(name, p, i) != "", F.concat(F.lit("-"), _number(_g(name, p, i)))).otherwise("")
    return F.when(name.rlike(archive), F.concat(F.lit("TS 1"), _g(name, archive, 1), F.lit(" "), _g(name, archive, 2), part(archive, 3))).when(
        name.rlike(typed), F.concat(F.upper(_g(name, typed, 1)), F.lit(" "), _g(name, typed, 2), F.lit(" "), _g(name, typed, 3), part(typed, 4))
    )


def html_doc_id(name: Column) -> Column:
    return F.translate(F.regexp_replace(name, r"(?i)\.html$", ""), "_", " ")


def text_doc_id(name: Column) -> Column:
    n = _g(name, r"(?i)rfc(\d+)\.txt", 1)
    return F.when(n != "", F.concat(F.lit("RFC "), n))


def document_line(norm: Column, version: Column, title: Column) -> Column:
    """norm, version and the beginning of a title on one line."""
    v = F.when(F.coalesce(version, F.lit("")) != "", F.concat(F.lit(" v"), F.ltrim(version, F.lit("vV")))).otherwise("")
    t = F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(" — "), F.left(title, F.lit(70)))).otherwise("")
    return F.trim(F.concat(F.coalesce(norm, F.lit("")), v, t))


def canonical_norm(norm: Column) -> Column:
    """File norms of the long form end in a spaced part number; this has it as -1, as elsewhere."""
    p = r"^([A-Z]+ \d{3} \d{3}) 0*(\d+)$"
    return F.when(norm.rlike(p), F.concat(_g(norm, p, 1), F.lit("-"), _g(norm, p, 2))).otherwise(norm)


def loose_key(c: Column) -> Column:
    """For matching however a number is spaced: no blanks, hyphens or underscores, lower case."""
    return F.lower(F.regexp_replace(c, r"[\s_-]+", ""))


def safe_stem(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def normalized_ref(c: Column) -> Column:
    """TYPE NNN NNN[-P] from any spacing; null if it isn't such a reference."""
    p = r"(?i)(EN|TS|TR|ES|EG|SR)\s*(\d{3})\s*(\d{3})(-\d+)?"
    return F.when(c.rlike(p), F.concat(F.upper(_g(c, p, 1)), F.lit(" "), _g(c, p, 2), F.lit(" "), _g(c, p, 3), _g(c, p, 4)))


def digits_doc_id(name: Column) -> Column:
    """Six digits of a name read as AAA BBB, eight or nine with a part, anything else as it is."""
    d = F.regexp_extract(name, r"^[A-Za-z]+_(\d+)v", 1)
    kind = F.upper(F.regexp_extract(name, r"^([A-Za-z]+)_", 1))
    base = F.concat(kind, F.lit(" "), F.substr(d, F.lit(1), F.lit(3)), F.lit(" "), F.substr(d, F.lit(4), F.lit(3)))
    return F.when(F.length(d) == 6, base).when(F.length(d).isin(8, 9), F.concat(base, F.lit("-"), _number(F.substr(d, F.lit(7), F.lit(3))))).otherwise(name)


def doc_type(c: Column) -> Column:
    t = F.upper(F.regexp_extract(c, r"(?i)\b(EN|TS|TR|ES|EG)\b", 1))
    return F.when(t == "", "Other").otherwise(t)


def section_depth(c: Column) -> Column:
    return F.size(F.split(c, r"\."))


def version_key(c: Column) -> Column:
    """(major, minor, patch), which orders as versions do; null where the form is another."""
    p = r"^v(\d+)\.(\d+)\.(\d+)$"
    return F.when(c.rlike(p), F.struct(*[_g(c, p, i).cast("int").alias(n) for i, n in ((1, "major"), (2, "minor"), (3, "patch"))]))
