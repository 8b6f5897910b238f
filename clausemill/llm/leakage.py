"""Evaluation items leaking into documents: template windows, a hash join, and slot checks.

A text's words (runs of letters or digits, lower-cased) are read twice. In both readings numbers and units are typed
placeholders; in the second, words written with a capital within a sentence are names and become placeholders too. A
word's reading depends on nothing but itself and the mark before it, so templates don't depend on what else is loaded.
Every window of 12 words of either reading is hashed; a second reading with more than MOST_SLOTS placeholders says too
little and makes no window.

Items' windows are a table. Documents' windows are joined with it by hash in Spark; before that, a Bloom filter of the
items' hashes, of bounded size, drops in the task that reads a document nearly every window that no item has, so what is
shuffled grows with what leaks and not with the corpus. The filter never drops a window that an item has. The words of
both windows are compared after the join: equal words are a verbatim passage; other slots, filled consistently over all
windows of a document and item, a re-parameterised item.

Defined results: null and empty texts, and items shorter than a window, leak nothing; null keys come out as null;
repeated documents or items under one key are one pair; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import materialize

WINDOW, MOST_SLOTS = 12, 6
#: Bits of the filter for each window of the items, and the powers of two between which its size lies (at most 64 MB).
FILTER_BITS, LEAST_LOG, MOST_LOG, BLOCK_LOG = 24, 16, 29, 16
#: Words that count things, in the singular and plural; which of them follows a number may be changed with the number.
UNITS = frozenset(
    "attempt attempts copy copies day days hour hours minute minutes month months octet octets week weeks witness witnesses "
    "year years tag tage mal stunden wochen monate jahre jour jours fois heures semaines mois ans".split()
)
_TOKEN = regex.compile(r"[.!?:\n]|[^\W_]+")
_MARKS = frozenset(".!?:\n")
# A word's code: 61 bits of its hash, then whether it has a capital, is a placeholder, is a mark.
_CAPITAL, _SLOT, _MARK = 1, 2, 4
_NUM, _UNIT, _NAME = (k << 3 | _SLOT for k in (1, 2, 3))
_CACHE = 400_000
_SEEDS = tuple(np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        low = word.lower()
        if word in _MARKS:
            out = _MARK
        elif any(c.isdigit() for c in low):
            out = _NUM
        elif low in UNITS:
            out = _UNIT
        else:
            out = xxhash.xxh3_64_intdigest(low) & ~7 | (_CAPITAL if word[:1].isupper() else 0)
        if len(self) > _CACHE:
            self.clear()
        self[word] = out
        return out


def _hashes(ids: np.ndarray, window: int) -> np.ndarray:
    out = np.zeros(max(0, ids.size - window + 1), np.uint64)
    x = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    x ^= x >> np.uint64(29)
    p = np.uint64(1)
    for k in range(window):
        out += x[k : k + out.size] * p
        p = np.uint64((int(p) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF)
    return out


def _inside(flags: np.ndarray, window: int) -> np.ndarray:
    """How many of each window's words are flagged."""
    upto = np.concatenate(([0], np.cumsum(flags)))
    return upto[window:] - upto[:-window]


def windows(texts: list[str | None], codes: _Codes, window: int, wanted: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(number of the text, hash, words) of the distinct windows of either reading whose hash is wanted."""
    tokens = [_TOKEN.findall(t) if t else [] for t in texts]
    sizes = np.array([len(t) for t in tokens], np.int64)
    code = np.fromiter((codes[w] for t in tokens for w in t), np.uint64, int(sizes.sum()))
    mark = (code & np.uint64(_MARK)) > 0
    doc = np.repeat(np.arange(sizes.size), sizes)
    after = np.concatenate(([True], mark[:-1])) | (np.concatenate(([-1], doc[:-1])) != doc)
    word = ~mark
    code, doc, after = code[word], doc[word], after[word]
    if code.size < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), []
    capital = (code & np.uint64(_CAPITAL)) > 0
    first = np.where(capital, code ^ np.uint64(_CAPITAL), code)
    named = capital & ~after
    second = np.where(named, np.uint64(_NAME), first)
    whole = doc[window - 1 :] == doc[: doc.size - window + 1]
    other = whole & (_inside(named, window) > 0) & (_inside((second & np.uint64(_SLOT)) > 0, window) <= MOST_SLOTS)
    found = []
    for ids, ok in ((first, whole), (second, other)):
        at = np.flatnonzero(ok)
        h = _hashes(ids, window)[at]
        keep = wanted(h)
        found.append((at[keep], h[keep]))
    at, h = (np.concatenate(x) for x in zip(*found))
    begins = np.searchsorted(doc, np.arange(sizes.size))
    texts_of: dict[int, list[str]] = {}
    out: dict[tuple[int, int, str], None] = {}
    for d, i, x in zip(doc[at].tolist(), at.tolist(), h.tolist()):
        if d not in texts_of:
            texts_of[d] = [w.lower() for w in tokens[d] if w not in _MARKS]
        i -= int(begins[d])
        out[d, x, " ".join(texts_of[d][i : i + window])] = None
    return np.array([k[0] for k in out], np.int64), np.array([k[1] for k in out], np.uint64), [k[2] for k in out]


def _positions(h: np.ndarray, log: int) -> list[np.ndarray]:
    return [((h * s) >> np.uint64(64 - log)).astype(np.int64) for s in _SEEDS]


def _window_rows(df: DataFrame, key: str, window: int, filtered=None, log: int = 0) -> DataFrame:
    """(key, h, w): the windows of df (key, text), of a filtered corpus only those that the filter lets through."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        bits = None if filtered is None else np.frombuffer(filtered.value, np.uint8)

        def wanted(h: np.ndarray) -> np.ndarray:
            keep = np.arange(h.size)
            for s in _SEEDS if bits is not None else ():
                p = ((h[keep] * s) >> np.uint64(64 - log)).astype(np.int64)
                keep = keep[(bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0]
            return keep

        for b in batches:
            doc, h, words = windows(b.column("text").to_pylist(), codes, window, wanted)
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(doc)), pa.array(h.view(np.int64)), pa.array(words, pa.string())], [key, "h", "w"])

    return df.where(F.length("text") > 0).select(key, "text").mapInArrow(run, f"{key} {kind}, h long, w string")


def _filter(hashes: DataFrame, n: int) -> tuple[bytes, int]:
    """A Bloom filter of the hashes, put together block by block in the tasks, and the logarithm of its bits."""
    log = min(MOST_LOG, max(LEAST_LOG, (max(1, n) * FILTER_BITS - 1).bit_length()))
    size = 1 << BLOCK_LOG

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (log - 3), np.uint8)
        for b in batches:
            for p in _positions(b.column("h").to_numpy().view(np.uint64), log):
                np.bitwise_or.at(own, p >> 3, np.left_shift(1, p & 7).astype(np.uint8))
        blocks = own.reshape(-1, size // 8)
        used = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([blocks[k].tobytes() for k in used], pa.binary())], ["block", "bits"])

    def united(t: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([np.frombuffer(v.as_py(), np.uint8) for v in t.column("bits")])
        return pa.table({"block": t.column("block")[:1], "bits": pa.array([both.tobytes()], pa.binary())})

    bits = bytearray(1 << (log - 3))
    for r in hashes.select("h").mapInArrow(set_bits, "block int, bits binary").groupBy("block").applyInArrow(united, "block int, bits binary").collect():
        bits[r["block"] * size // 8 : (r["block"] + 1) * size // 8] = r["bits"]
    return bytes(bits), log


def matched_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, w, v): windows of a document and of an item that are one template, with the words of both."""
    known = materialize(_window_rows(items, "item_id", window).distinct(), "leak-items")
    bits, log = _filter(known, known.count())
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    return _window_rows(docs, "doc_id", window, sent, log).join(known.withColumnRenamed("w", "v"), "h").select("doc_id", "item_id", "w", "v")


def verbatim_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    return matched_windows(docs, items).where(F.col("w") == F.col("v")).select("doc_id", "item_id").distinct()


def leaked_pairs(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, n_exact, n_template, consistent): every pair that shares at least one template window.

    Windows are counted by their words, once each. Slots are consistent if each word of the item's is one word of the
    document's wherever it is replaced; that is counted by word before it is by pair, so no pair's windows are collected.
    """
    hits = matched_windows(docs, items, window).distinct()
    each = F.arrays_zip(F.split("w", " ").alias("mine"), F.split("v", " ").alias("theirs"))
    other = F.filter(each, lambda x: x["mine"] != x["theirs"])
    rows = hits.select("doc_id", "item_id", (F.col("w") == F.col("v")).cast("int").alias("same"), F.posexplode_outer(other).alias("pos", "x"))
    rows = rows.select("doc_id", "item_id", "same", F.coalesce(F.col("pos") == 0, F.lit(True)).cast("int").alias("one"), "x.mine", "x.theirs")
    by_word = rows.groupBy("doc_id", "item_id", "theirs").agg(F.sum(F.col("same") * F.col("one")).alias("n_exact"), F.sum("one").alias("n_template"), (F.min("mine").eqNullSafe(F.max("mine"))).alias("consistent"))
    return by_word.groupBy("doc_id", "item_id").agg(F.sum("n_exact").cast("int").alias("n_exact"), F.sum("n_template").cast("int").alias("n_template"), F.min("consistent").alias("consistent"))


def reparameterised_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs without a verbatim window whose template windows have consistently other slots."""
    return leaked_pairs(docs, items).where("n_exact = 0 AND consistent").select("doc_id", "item_id", "n_template")
