"""Names of standards: aliases, resolving what was asked for, short names, and the archive keys that stand for numbers.

Defined results: null names are no names and null norms have none; a name that is its own norm isn't an alias; repeated
rows give one alias; what can't be resolved comes out as it was asked; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.functions.identifiers import PLACEHOLDER_VERSION, archive_key, archive_key_version, archive_norm, loose_key
from clausemill.functions.text import shortened, strip

# Bodies whose name may stand before a number.
BODIES = r"(?i)^(ETSI|CEN|ISO/IEC|ISO|IETF|RFC)\s+"
_STEM, _NUMBERED = r"(?i)^(ESI-00(\d{5})(-\d+)?)v", r"(?i)^(?:EN|TS|TR)\s+(\d{3})\s+(\d{3,4})(-\d+)?$"


def build_aliases(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """(alias, norm, alias_type): every way of naming a standard, once, of the first kind that gives it.

    rows (norm, version, source_file), titles (norm, number, wki_id). Kinds in their order: number and number with version
    of a title record, work item, archive key of a file and its prefix, and short forms of the norm.
    """
    known = rows.where("norm IS NOT NULL").select("norm", "version", "source_file").distinct()
    told = titles.where("norm IS NOT NULL").groupBy("norm").agg(F.max("number").alias("number"), F.max("wki_id").alias("wki_id"))
    r = known.join(told, "norm", "left")
    part = lambda c, p, i: F.nullif(F.regexp_extract(c, p, i), F.lit(""))
    series, number = part(F.col("norm"), _NUMBERED, 1), F.concat(part(F.col("norm"), _NUMBERED, 2), F.regexp_extract("norm", _NUMBERED, 3))
    version = F.nullif(F.col("version"), F.lit(""))
    ways = [
        (F.col("number"), "short"), (F.concat("number", F.lit(" "), version), "full"), (F.concat(F.lit("wki:"), "wki_id"), "work_item"),
        (F.when(F.col("source_file").rlike(_STEM), F.col("source_file")), "archive_key"), (F.regexp_replace(part(F.col("source_file"), _STEM, 1), "(?i)^esi", "ESI"), "archive_prefix"),
        (F.concat(series, F.lit(" "), number), "short"), (F.concat(series, number), "short"), (F.when(series.isNotNull(), F.concat(F.lit("ETSI "), "norm")), "short"),
    ]
    each = r.select("norm", F.posexplode(F.array(*[F.struct(F.trim(a).alias("alias"), F.lit(k).alias("alias_type")) for a, k in ways])).alias("at", "w")).select("norm", "at", "w.*")
    return each.where("alias IS NOT NULL AND alias <> '' AND alias <> norm").groupBy("alias", "norm").agg(F.min_by("alias_type", "at").alias("alias_type"))


def _ways(asked: str) -> list[tuple[str, str]]:
    """(column, part to be found in it) in the order in which they're tried."""
    raw = asked.strip().lower()
    bare = re.sub(BODIES, "", raw)
    digits = re.sub(r"\D", "", raw)
    archive = lambda d: [("archive", f"00{int(d) - 300_000:05d}")] if len(d) == 6 and int(d) > 300_000 else []
    out = [("low", raw)]
    if bare != raw:
        out += [("low", bare), *archive(re.sub(r"\D", "", bare))]
    if len(digits) in (6, 7):
        out.append(("low", f"{digits[:3]} {digits[3:6]}"))
    if len(digits) >= 5:
        out += [("bare", digits), *archive(digits)]
    return out


def resolve_names(norms: DataFrame, aliases: DataFrame, asked: Sequence[str]) -> DataFrame:
    """(asked, norm, way) for a short list of names: way 0 is the alias table, the others are parts found in a norm.

    The least way that matches wins, then the first norm. The names are a query's own few, so they're part of the plan and
    every norm is looked at once, without a join. Blanks, hyphens and underscores don't count in the alias table.
    """
    spark, names = norms.sparkSession, list(dict.fromkeys(asked))
    out = spark.createDataFrame([(a,) for a in names], "asked string")
    if not names:
        return out.select("asked", F.lit(None).cast("string").alias("norm"), F.lit(None).cast("int").alias("way"))
    squeezed = lambda a: re.sub(r"[\s_-]+", "", a).lower()
    key = loose_key(F.col("alias"))
    by_alias = F.filter(F.array(*[F.when(key == squeezed(a), F.lit(a)) for a in names]), lambda x: x.isNotNull())
    first = aliases.where(key.isin([squeezed(a) for a in names]) & F.col("norm").isNotNull()).select(F.explode(by_alias).alias("asked"), F.lit(0).alias("way"), "norm")
    cols = {"low": F.lower("norm"), "bare": F.regexp_replace("norm", r"[\s/-]", ""), "archive": F.col("norm")}
    tried = []
    for a in names:
        way = F.lit(None).cast("int")
        for i, (c, p) in reversed(list(enumerate(_ways(a), 1))):
            way = F.when(cols[c].contains(p), i).otherwise(way)
        tried.append(F.struct(F.lit(a).alias("asked"), way.alias("way")))
    second = norms.where("norm IS NOT NULL").select("norm").distinct().select("norm", F.inline(F.array(*tried))).where("way IS NOT NULL").select("asked", "way", "norm")
    best = first.unionByName(second).groupBy("asked").agg(F.min(F.struct("way", "norm")).alias("m"))
    return out.join(best, "asked", "left").select("asked", F.coalesce("m.norm", "asked").alias("norm"), F.col("m.way").alias("way"))


def display_names(catalogue: DataFrame) -> DataFrame:
    """catalogue (norm, version, title, ...) with label, which decodes archive keys, and display_name."""
    label = F.coalesce(archive_key(F.col("norm")), F.col("norm"))
    title = shortened(strip(F.coalesce("title", F.lit(""))), 80)
    head = F.concat(label, F.lit(" "), F.coalesce("version", F.lit("")))
    return catalogue.withColumn("label", label).withColumn("display_name", strip(F.when(title != "", F.concat(head, F.lit(" — "), title)).otherwise(head)))


def short_names(docs: DataFrame, sidecars: DataFrame, static: DataFrame) -> DataFrame:
    """docs (norm, ...) with shortname and shortname_source: a title record's, else the static list's, else ''.

    Both lists (norm, shortname) are compared by norm without blanks, hyphens, underscores and case; the last name in order wins.
    """
    side = lambda df, name: df.where("norm IS NOT NULL AND shortname <> ''").groupBy(loose_key(F.col("norm")).alias("__key")).agg(F.max("shortname").alias(name))
    keyed = docs.drop("shortname", "shortname_source").withColumn("__key", loose_key(F.col("norm")))
    both = keyed.join(side(sidecars, "__a"), "__key", "left").join(side(static, "__b"), "__key", "left")
    source = F.when(F.col("__a").isNotNull(), "sidecar").when(F.col("__b").isNotNull(), "static").otherwise("")
    return both.withColumns({"shortname": F.coalesce("__a", "__b", F.lit("")), "shortname_source": source}).drop("__key", "__a", "__b")


def backfilled_keys(rows: DataFrame) -> DataFrame:
    """rows (norm, version, ...) with archive keys in norm replaced by the number they stand for, each version by itself;
    a version is replaced only where it's the placeholder."""
    key = F.col("norm")
    norm, version = archive_key(key), archive_key_version(key)
    is_key = norm.isNotNull() & version.isNotNull()
    return rows.withColumns({"norm": F.when(is_key, norm).otherwise(key), "version": F.when(is_key & (F.col("version") == PLACEHOLDER_VERSION), version).otherwise(F.col("version"))})


def _runs(name: Column) -> Column:
    """The runs of digits in a name, without leading zeros."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), lambda d: F.ltrim(d, F.lit("0")))


def files_of_numbers(numbers: DataFrame, files: DataFrame) -> DataFrame:
    """(number, path): the file whose name holds a number's digits as a whole run; null where there is none.

    An archive key with a part needs a file with both runs one after the other, and no other part's file stands in for it;
    other numbers are looked for by their first seven, then their first six digits. The first name wins. Runs are joined by
    equality, so no number meets every file.
    """
    n = F.col("number")
    archive = r"ESI-0*(\d{5,7})(?:-(\d+))?"
    core, part = F.ltrim(F.regexp_extract(n, archive, 1), F.lit("0")), F.ltrim(F.regexp_extract(n, archive, 2), F.lit("0"))
    digits = F.regexp_replace(n, r"\D", "")
    prefix = lambda k: F.when(F.length(digits) >= k, F.ltrim(F.left(digits, F.lit(k)), F.lit("0")))
    keys = F.when(part != "", F.array(F.concat(core, F.lit("-"), part))).otherwise(F.array_compact(F.array(F.nullif(core, F.lit("")), prefix(7), prefix(6))))
    asked = numbers.where(n.isNotNull()).select("number").distinct()
    wanted = asked.select("number", F.posexplode(keys).alias("way", "key"))
    runs = _runs(F.lower("name"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("runs") - 1), lambda i: F.concat(F.element_at("runs", i), F.lit("-"), F.element_at("runs", i + 1)))
    held = files.select("path", "name", runs.alias("runs")).where(F.size("runs") > 0)
    held = held.select("path", "name", F.explode(F.array_distinct(F.when(F.size("runs") > 1, F.concat("runs", pairs)).otherwise(F.col("runs")))).alias("key"))
    best = wanted.join(held, "key").groupBy("number").agg(F.min_by("path", F.struct("way", "name", "path")).alias("path"))
    return asked.join(best, "number", "left")


def urls_of_files(files: DataFrame, sidecars: DataFrame, results: DataFrame, items: DataFrame) -> DataFrame:
    """(path, url, source): where a file came from, by its own record, the last run's results, or a work item's page.

    sidecars and results (path, url); items (pos, number, url), of which the last wins among those with the same first seven,
    six or five digits, and longer prefixes before shorter ones.
    """
    first = lambda c: F.transform(F.array(*[F.lit(k) for k in (7, 6, 5)]), lambda k: F.when(F.length(c) >= k, F.left(c, k)))
    digits = lambda c: F.regexp_replace(c, r"\D", "")
    by_key = items.where("url IS NOT NULL").select("pos", "url", F.explode(first(digits(F.col("number")))).alias("key")).where("key IS NOT NULL").groupBy("key").agg(F.max_by("url", "pos").alias("item_url"))
    name = F.element_at(F.split("path", "/"), -1)
    paths = files.where("path IS NOT NULL").select("path").distinct()
    named = paths.select("path", F.posexplode(first(digits(name))).alias("way", "key")).where("key IS NOT NULL")
    found = named.join(by_key, "key").groupBy("path").agg(F.min_by("item_url", "way").alias("item_url"))
    one = lambda df, c: df.where("url IS NOT NULL").groupBy("path").agg(F.max("url").alias(c))
    all_ = paths.join(one(sidecars, "a"), "path", "left").join(one(results, "b"), "path", "left").join(found, "path", "left")
    source = F.when(F.col("a").isNotNull(), "sidecar").when(F.col("b").isNotNull(), "results").when(F.col("item_url").isNotNull(), "item")
    return all_.select("path", F.coalesce("a", "b", "item_url").alias("url"), source.alias("source"))


def repaired_work_items(pages: DataFrame, overview: DataFrame) -> DataFrame:
    """(number, wki_id, source) of work-item pages (number, wki_id, html): as recorded, from the overview's URL, from the page."""
    known = overview.where("number IS NOT NULL").groupBy("number").agg(F.max("url").alias("url"))
    of = lambda c: F.nullif(F.regexp_extract(c, r"(?i)WKI_ID=(\d+)", 1), F.lit(""))
    own = F.when(F.col("wki_id") != "unknown", F.col("wki_id"))
    r = pages.join(known, "number", "left")
    source = F.when(own.isNotNull(), "recorded").when(of(F.col("url")).isNotNull(), "overview").when(of(F.col("html")).isNotNull(), "page")
    return r.select("number", F.coalesce(own, of(F.col("url")), of(F.col("html"))).alias("wki_id"), source.alias("source"))
