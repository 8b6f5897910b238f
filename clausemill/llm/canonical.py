"""Mapping free-entered values to a reference list: a prefix-filter set-similarity join.

A value is read into probes, each a set of tokens: the document number it holds (misread digits set right), a work-item
number, an abbreviation, the words of a title and the letters of a short name, both as padded trigrams. The reference
list's entries are read into the same kinds of sets. Tokens are ordered by their rarity over both sides; two sets can
reach the threshold only if their prefixes in that order meet, so only prefixes are joined; length and position filters
drop most of what meets, Jaccard is verified exactly on the rest, and the best is kept. Numbers and codes are sets of one
token, so they match whole or not at all; they take precedence over words, and words decide where a number is unknown.

Equal values are mapped once. Rarity is counted over the reference list, whose tokens alone can be shared: a token that the
list lacks is the rarest, so that the order needs no count over all values. While the list has at most LIST_TOKENS tokens,
its prefix index is sent to the tasks that read the values, and a batch of values is probed at once; a larger list is
joined with the values' prefixes by shuffle. Both ways verify every candidate and give the same pairs.

Defined results: a null or empty value, and one that ties between entries, is unmatched (''); entries with null fields
lack those probes; repeated entries are one; repeated rows come out repeatedly; empty tables: nothing, or all unmatched;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import materialize

#: Half of the trigrams of two misspelt titles of equal length are still shared; 0.48 leaves room for one more.
THRESHOLD = ACCEPT = 0.48
#: Tokens, over all its sets, of a list that is sent to every task (about 16 bytes each).
LIST_TOKENS = 4_000_000
#: Digits as they're misread, and abbreviated title words with their full forms.
MISREAD, DIGITS = "oilzbs", "011285"
SHORT_WORDS = {r"\bsec\.": "security", r"\breqs\.": "requirements", r"\bconf\.": "conformance", r"\bf\.": "for"}
_D = "[0-9oilzbs]"
_PART = rf"(?:\s*(?:[-–/]\s*0*|,?\s*(?:part|pt)[\s.]*0*)([1-9ilzbs])(?![0-9a-z]))?"
_NUMBER = rf"(?<![a-z0-9])(?:(en|ts|tr|es|eg)[\s._-]*)?({_D}{{3}})[\s._-]*({_D}{{3}})(?![0-9a-z]){_PART}"
_DRAFT_KEY = r"esi-00(\d{5})(?:-(\d)(?!\d))?"
_ITEM = r"(?:wki(?:_id)?|work item)[\s:=_]*(\d{4,})"
_NOISE = r"\bv\d+(\.\d+)+\b|\(\d{4}-\d{2}\)|\b(final draft|draft|etsi|std\.|see|new wi on)(?![a-z])"


def _digits(c: Column) -> Column:
    return F.translate(c, MISREAD, DIGITS)


def _trigrams(word: Column, kind: str) -> Column:
    padded = F.concat(F.lit("#"), word, F.lit("#"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.concat(F.lit(kind), F.substr(padded, i, F.lit(3))))


def _title_set(text: Column) -> Column:
    for short, full in SHORT_WORDS.items():
        text = F.regexp_replace(text, short, full)
    words = F.filter(F.split(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(words, lambda w: _trigrams(w, "t:"))))


def _letters(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}]+", "")


def _name_set(text: Column) -> Column:
    return F.array_distinct(_trigrams(_letters(text), "s:"))


def _one(present: Column, token: Column) -> Column:
    return F.when(present, F.array(token))


def value_probes(values: DataFrame) -> DataFrame:
    """(value, kind, tokens) of each distinct value."""
    low = F.lower(F.trim(F.col("value")))
    v = values.select("value", low.alias("low"))
    real = F.length(F.regexp_replace(F.concat(F.regexp_extract("low", _NUMBER, 2), F.regexp_extract("low", _NUMBER, 3)), r"[^0-9]", "")) >= 4
    v = v.withColumns({
        "has": real,
        "num": _digits(F.concat(F.regexp_extract("low", _NUMBER, 2), F.regexp_extract("low", _NUMBER, 3))),
        "part": _digits(F.regexp_extract("low", _NUMBER, 4)),
        "body": F.regexp_extract("low", _NUMBER, 1),
        "key": F.regexp_extract("low", _DRAFT_KEY, 1),
        "key_part": F.regexp_extract("low", _DRAFT_KEY, 2),
        "item": F.regexp_extract("low", _ITEM, 1),
        "rest": F.regexp_replace(F.regexp_replace("low", _NOISE, " "), rf"{_NUMBER}|{_DRAFT_KEY}|{_ITEM}", " "),
    })
    dash = lambda p: F.when(p != "", F.concat(F.lit("-"), p)).otherwise("")
    long = F.length(_letters(F.col("rest"))) >= 6
    code = F.lower(F.regexp_extract("value", r"(?<![A-Za-z0-9])([A-Z]{4,}[0-9]?)(?![A-Za-z0-9])", 1))
    whole = F.regexp_replace("low", r"[^a-z0-9]+", "")
    probes = [
        ("number", _one(F.col("has"), F.concat(F.lit("n:"), "body", "num", dash(F.col("part"))))),
        ("number", _one(F.col("key") != "", F.concat(F.lit("n:en"), (F.col("key").cast("int") + 300000).cast("string"), dash(F.col("key_part"))))),
        ("item", _one(F.col("item") != "", F.concat(F.lit("i:"), "item"))),
        ("code", _one(whole.rlike("^[a-z]{4,7}[0-9]?$"), F.concat(F.lit("c:"), whole))),
        ("code", _one(code != "", F.concat(F.lit("c:"), code))),
        ("title", F.when(long, _title_set(F.col("rest")))),
        ("name", F.when(long, _name_set(F.col("rest")))),
    ]
    return _long(v, ["value"], probes)


def _long(df: DataFrame, keys: list[str], probes: list[tuple[str, Column]]) -> DataFrame:
    each = F.explode(F.array_distinct(F.array(*[F.struct(F.lit(k).alias("kind"), t.alias("tokens")) for k, t in probes])))
    return df.select(*keys, each.alias("p")).select(*keys, "p.kind", "p.tokens").where(F.size("tokens") > 0)


def entry_sets(entries: DataFrame) -> DataFrame:
    """(norm, kind, tokens) of each entry of the reference list."""
    e = entries.where(F.col("norm").isNotNull()).withColumn("squeezed", F.regexp_replace(F.lower("norm"), r"[^a-z0-9-]+", ""))
    title = F.lower(F.regexp_replace("title", r"^[^;]*\([A-Z]+\);\s*", ""))
    return _long(e, ["norm"], [
        ("number", _one(F.col("squeezed") != "", F.concat(F.lit("n:"), "squeezed"))),
        ("number", _one(F.col("squeezed") != "", F.concat(F.lit("n:"), F.regexp_replace("squeezed", "^[a-z]+", "")))),
        ("item", _one(F.col("wki_id").isNotNull(), F.concat(F.lit("i:"), F.col("wki_id").cast("string")))),
        ("code", _one(F.col("abbr").isNotNull(), F.concat(F.lit("c:"), F.lower("abbr")))),
        ("title", _title_set(title)),
        ("name", _name_set(F.lower("shortname"))),
    ])


def _ordered(sets: DataFrame, keys: list[str], rank: DataFrame) -> DataFrame:
    """sets with their tokens in the order of global rarity."""
    flat = sets.select(*keys, "kind", F.xxhash64("tokens").alias("which"), F.explode("tokens").alias("token"))
    rarity = F.coalesce("rarity", F.lit(0)).alias("rarity")
    listed = flat.join(rank, "token", "left").groupBy(*keys, "kind", "which").agg(F.sort_array(F.collect_list(F.struct(rarity, "token"))).alias("o"))
    return listed.select(*keys, "kind", F.col("o.token").alias("tokens"), F.size("o").alias("n"))


def _least(c: Column) -> Column:
    """The least whole number that isn't below c but for rounding."""
    return F.ceil(c - 1e-9)


def _prefixes(sets: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    size = (F.col("n") - _least(F.lit(threshold) * F.col("n")) + 1).cast("int")
    return sets.select(*keys, "kind", "tokens", "n", F.posexplode(F.slice("tokens", F.lit(1), size)).alias("pos", "token"))


class ListIndex:
    """The reference list's sets as arrays: tokens by rarity, each set's tokens in that order, and its prefix postings."""

    def __init__(self, sets: list[tuple[str, str, list[str]]], threshold: float):
        self.threshold = threshold
        self.norms = [s[0] for s in sets]
        counts: dict[str, int] = {}
        for _, kind, tokens in sets:
            for t in tokens:
                counts[f"{kind} {t}"] = counts.get(f"{kind} {t}", 0) + 1
        self.rank = {t: i for i, t in enumerate(sorted(counts, key=lambda t: (counts[t], t)))}
        own = [np.sort(np.array([self.rank[f"{kind} {t}"] for t in tokens], np.int64)) for _, kind, tokens in sets]
        self.size = np.array([o.size for o in own], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.tokens = np.concatenate(own) if own else np.zeros(0, np.int64)
        entry = np.repeat(np.arange(self.size.size), self.size)
        place = np.arange(entry.size) - self.begin[entry]
        keep = place < self.size[entry] - self._least(self.threshold * self.size[entry]) + 1
        o = np.argsort(self.tokens[keep], kind="stable")
        self.post, self.place = entry[keep][o], place[keep][o]
        self.upto = np.searchsorted(self.tokens[keep][o], np.arange(len(self.rank) + 1))

    @staticmethod
    def _least(x: np.ndarray) -> np.ndarray:
        return np.ceil(x - 1e-9).astype(np.int64)

    @staticmethod
    def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
        """begin, begin + 1, ... n of each, one after the other."""
        return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

    def probe(self, kinds: list[str], tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, entry, similarity) of all pairs that reach the threshold."""
        n = np.array([len(t) for t in tokens], np.int64)
        row = np.repeat(np.arange(n.size), n)
        get = self.rank.get
        ids = np.fromiter((get(f"{k} {t}", -1) for k, ts in zip(kinds, tokens) for t in ts), np.int64, row.size)
        o = np.lexsort((ids, row))  # tokens that the list lacks come first in each row
        row, ids = row[o], ids[o]
        place = np.arange(row.size) - (np.cumsum(n) - n)[row]
        known = ids >= 0
        first = known & (place < (n - self._least(self.threshold * n) + 1)[row])
        r, t, at = row[first], ids[first], place[first]
        many = self.upto[t + 1] - self.upto[t]
        p = self._spread(self.upto[t], many)
        r, at, y, there = np.repeat(r, many), np.repeat(at, many), self.post[p], self.place[p]
        m = self.size[y]
        # what can still follow after the place of a shared token bounds the overlap that begins with it
        least = self._least(self.threshold / (1 + self.threshold) * (n[r] + m))
        ok = (n[r] >= self.threshold * m) & (m >= self.threshold * n[r]) & (1 + np.minimum(n[r] - at - 1, m - there - 1) + np.minimum(at, there) >= least)
        pair = np.unique(r[ok] * self.size.size + y[ok])
        r, y = pair // max(1, self.size.size), pair % max(1, self.size.size)
        held = row[known] * len(self.rank) + ids[known]
        mine = np.repeat(r, self.size[y]) * len(self.rank) + self.tokens[self._spread(self.begin[y], self.size[y])]
        i = np.minimum(np.searchsorted(held, mine), max(0, held.size - 1))
        common = np.bincount(np.repeat(np.arange(r.size), self.size[y])[held[i] == mine] if held.size else [], minlength=r.size)
        similarity = common / np.maximum(1, n[r] + self.size[y] - common)
        good = similarity >= self.threshold - 1e-12
        return r[good], y[good], similarity[good]


def similar_pairs(probes: DataFrame, sets: DataFrame, threshold: float = THRESHOLD, list_tokens: int = LIST_TOKENS) -> DataFrame:
    """(value, norm, kind, similarity) of all pairs of one kind whose Jaccard similarity reaches threshold.

    Tokens of a set are distinct. Pairs are distinct too, if one value's sets of a kind are.
    """
    held = sets.distinct()
    if held.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0] > list_tokens:
        return _joined_pairs(probes, held, threshold)
    listed = probes.sparkSession.sparkContext.broadcast(sorted((r["norm"], r["kind"], r["tokens"]) for r in held.select("norm", "kind", "tokens").collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ListIndex(listed.value, threshold)
        norms = pa.array(index.norms, pa.string())
        for b in batches:
            r, y, similarity = index.probe(b.column("kind").to_pylist(), b.column("tokens").to_pylist())
            at = pa.array(r)
            yield pa.RecordBatch.from_arrays([b.column("value").take(at), norms.take(pa.array(y)), b.column("kind").take(at), pa.array(similarity)], ["value", "norm", "kind", "similarity"])

    return probes.select("value", "kind", "tokens").mapInArrow(run, "value string, norm string, kind string, similarity double").distinct()


def _joined_pairs(probes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """similar_pairs by shuffle. Only prefixes are joined, as narrow rows. What a pair shares in its prefixes, and what can
    follow after its last shared positions, bounds its overlap; the sets are attached to what this leaves, and verified."""
    rank = sets.select("kind", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("rarity"))
    spread = max(2, probes.sparkSession.sparkContext.defaultParallelism)
    left = materialize(_ordered(probes, ["value"], rank).withColumn("x", F.xxhash64("value", "kind", "tokens")).repartition(spread, "x"), "list-values")
    right = materialize(_ordered(sets, ["norm"], rank).withColumn("y", F.xxhash64("norm", "kind", "tokens")), "list-entries")
    theirs = _prefixes(right, ["y"], threshold).select("kind", "token", "y", F.col("n").alias("m"), F.col("pos").alias("at"))
    n, m = F.col("n"), F.col("m")
    need = _least(F.lit(threshold / (1 + threshold)) * (n + m))
    met = (
        _prefixes(left, ["x"], threshold).select("kind", "token", "x", "n", "pos").repartition(spread, "x")
        .join(theirs, ["kind", "token"])
        .where((n >= F.lit(threshold) * m) & (m >= F.lit(threshold) * n))
        .groupBy("x", "y", "n", "m").agg(F.count("*").alias("met"), F.max("pos").alias("pos"), F.max("at").alias("at"))
        .where(F.col("met") + F.least(n - F.col("pos") - 1, m - F.col("at") - 1) >= need)
    )
    entries = right.select("y", "norm", F.col("tokens").alias("theirs"))
    pairs = met.select("x", "y", "n", "m").join(left.select("x", "value", "kind", "tokens"), "x").join(entries, "y")
    common = F.size(F.array_intersect("tokens", "theirs"))
    return pairs.select("value", "norm", "kind", (common / (n + m - common)).alias("similarity")).where(F.col("similarity") >= threshold - 1e-12).distinct()


def map_to_list(aliases: DataFrame, entries: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(alias_id, alias, norm, kind, similarity): the entry meant by each alias; '' and nulls where none is."""
    spread = max(2, aliases.sparkSession.sparkContext.defaultParallelism)
    # few bytes, much work: a distinct value's probes are worth a task of their own share
    values = aliases.where(F.col("alias").isNotNull()).select(F.col("alias").alias("value")).distinct().repartition(spread, "value")
    pairs = similar_pairs(value_probes(values), entry_sets(entries), min(THRESHOLD, accept))
    order = F.create_map(*[F.lit(x) for kv in (("number", 0), ("item", 1), ("code", 2), ("title", 3), ("name", 3)) for x in kv])
    ranked = pairs.where((F.col("similarity") >= accept) | ~F.col("kind").isin("title", "name")).withColumn("prior", order[F.col("kind")])
    by_entry = ranked.groupBy("value", "prior", "norm").agg(F.max(F.struct("similarity", "kind")).alias("s"))
    best = by_entry.groupBy("value").agg(F.sort_array(F.collect_list(F.struct("prior", (-F.col("s.similarity")).alias("far"), "norm", F.col("s.kind").alias("kind")))).alias("o"))
    first, second = F.col("o")[0], F.try_element_at("o", F.lit(2))
    tie = second.isNotNull() & (first["prior"] == second["prior"]) & (first["far"] == second["far"])
    found = best.where(~tie).select(F.col("value").alias("__value"), first["norm"].alias("__norm"), first["kind"].alias("kind"), (-first["far"]).alias("similarity"))
    a = aliases.select("alias_id", "alias")
    return a.join(found, a["alias"] == found["__value"], "left").select("alias_id", "alias", F.coalesce("__norm", F.lit("")).alias("norm"), "kind", "similarity")
