"""Splitting oversized texts at natural boundaries, with an overlap, all greedy cuts at once.

Every legal cut of a text is a node. A node's successor is the farthest cut that the piece beginning in its overlap may
reach: at a paragraph, line, sentence or word end, the best of these that fills at least half of the limit. From the
successor table, squared again and again, all cuts of all texts of a batch come out in about log2(pieces) array steps:
after k squarings the first 2^k cuts are marked. Rows are independent, so nothing is shuffled and short texts never
leave the JVM.

Lengths are in code points. Defined results: null and empty texts, and texts within the limit, have no pieces; stretches
without white space are cut within; pieces are exact substrings, so that dropping each overlap gives the text back;
repeated rows give repeated pieces; empty tables give empty results; columns other than the id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIMIT, LEAST_OVERLAP, MOST_OVERLAP = 1800, 100, 200
#: A white-space run with what precedes it; its kind says how natural a cut after it is.
_GAP = regex.compile(r"(?P<para>\n\s*\n\s*)|(?P<line>\n\s*)|(?P<sent>(?<=[.!?:;][\"')\]]?)\s+)|(?P<word>\s+)")
_RANK = {"para": 4, "line": 3, "sent": 2, "word": 1}
_KINDS = np.array(["hard", "word", "sentence", "line", "paragraph", "end"])


def _nodes(text: str, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all legal cuts and their ranks, with 0 and the end; no two neighbours are more than step apart."""
    found = [(m.end(), _RANK[m.lastgroup]) for m in _GAP.finditer(text)]
    at = np.fromiter((p for p, _ in found), np.int64, len(found))
    rank = np.fromiter((r for _, r in found), np.int8, len(found))
    n = len(text)
    keep = (at > 0) & (at < n)
    at, rank = np.concatenate(([0], at[keep], [n])), np.concatenate(([5], rank[keep], [5]))
    wide = np.flatnonzero(np.diff(at) > step)
    if wide.size:
        more = np.concatenate([np.arange(at[i] + step, at[i + 1], step) for i in wide])
        at, rank = np.concatenate((at, more)), np.concatenate((rank, np.zeros(more.size, np.int8)))
        order = np.argsort(at, kind="stable")
        at, rank = at[order], rank[order]
    return at, rank


def _farthest(at: np.ndarray, rank: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> np.ndarray:
    """For each (low, high], the index of the last node of rank at least `least` in it, or -1."""
    which = np.flatnonzero(rank >= least)
    if not which.size:
        return np.full(low.shape, -1)
    i = np.searchsorted(at[which], high, "right") - 1
    return np.where((i >= 0) & (at[which[np.maximum(i, 0)]] > low), which[np.maximum(i, 0)], -1)


def successors(at: np.ndarray, rank: np.ndarray, limit: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node as a cut: the node where the next piece begins, and the farthest legal node where that piece ends."""
    n = at[-1]
    low, high = at - most - 1, at - least
    begin = np.full(at.shape, -1)
    for want in (2, 1, 0):
        begin = np.where(begin < 0, _farthest(at, rank, low, high, want), begin)
    begin = np.where(at == 0, 0, begin)
    begin = np.where(begin < 0, np.maximum(np.searchsorted(at, np.maximum(high, 0), "right") - 1, 0), begin)
    start = at[begin]
    reach = np.minimum(start + limit, n)
    after = np.full(at.shape, -1)
    for want in (4, 3, 2, 1):
        after = np.where(after < 0, _farthest(at, rank, np.maximum(start + limit // 2, at), reach, want), after)
    after = np.where(after < 0, _farthest(at, rank, at, reach, 0), after)
    after = np.where(reach >= n, at.size - 1, after)
    return begin, after


def cuts(after: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All nodes reached from starts, by marking and squaring the successor table."""
    marked = np.zeros(after.size, bool)
    marked[starts] = True
    jump = after
    while True:
        new = marked.copy()
        new[jump[marked]] = True
        if (new == marked).all():
            return np.flatnonzero(marked)
        marked, jump = new, jump[jump]


def split_batch(texts: list[str], limit: int = LIMIT, least: int = LEAST_OVERLAP, most: int = MOST_OVERLAP) -> list[list[tuple[int, int, str]]]:
    """(begin, end, kind of cut) of the pieces of each text longer than the limit."""
    step = max(1, (most - least) // 2)
    parts, base = [], 0
    for t in texts:
        at, rank = _nodes(t, step)
        begin, after = successors(at, rank, limit, least, most)
        parts.append((at, rank, begin, after + base, base))
        base += at.size
    if not parts:
        return []
    after = np.concatenate([p[3] for p in parts])
    reached = cuts(after, np.array([p[4] for p in parts]))
    out = []
    for at, rank, begin, succ, base in parts:
        mine = reached[np.searchsorted(reached, base) : np.searchsorted(reached, base + at.size)] - base
        ends = mine[1:]
        out.append([(int(at[begin[c]]), int(at[e]), str(_KINDS[rank[e]])) for c, e in zip(mine[:-1], ends)])
    return out


def split_oversized(rows: DataFrame, key: str = "row_nr", limit: int = LIMIT, least: int = LEAST_OVERLAP, most: int = MOST_OVERLAP) -> DataFrame:
    """(key, piece_nr, begin_at, end_at, cut, piece) of every text longer than limit; piece_nr counts from 1."""
    if not 0 < least < most < limit // 2:
        raise ValueError("the overlap must lie between 0 and half of the limit")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = list(b["text"])
            got = [
                (k, i, s, e, kind, t[s:e])
                for k, t, pieces in zip(b[key], texts, split_batch(texts, limit, least, most))
                for i, (s, e, kind) in enumerate(pieces, 1)
            ]
            yield pd.DataFrame(got, columns=[key, "piece_nr", "begin_at", "end_at", "cut", "piece"])

    # keys travel as strings: pandas would turn whole numbers beside nulls into floats
    long = rows.where(F.length("text") > limit).select(F.col(key).cast("string").alias(key), "text")
    out = long.mapInPandas(run, f"{key} string, piece_nr int, begin_at int, end_at int, cut string, piece string")
    return out.withColumn(key, F.col(key).cast(dict(rows.dtypes)[key]))


def rejoined(pieces: DataFrame, key: str = "row_nr", limit: int = LIMIT, least: int = LEAST_OVERLAP, most: int = MOST_OVERLAP) -> DataFrame:
    """(key, text, in_limits): each text put together from its pieces, and whether these keep to the limit and the overlap."""
    w = Window.partitionBy(key).orderBy("piece_nr")
    overlap = F.lag("end_at").over(w) - F.col("begin_at")
    rows = pieces.select(key, "piece_nr", F.coalesce(overlap, F.lit(0)).alias("again"), "piece", ((F.length("piece") <= limit) & F.coalesce(overlap.between(least, most), F.lit(True))).alias("ok"))
    part = F.struct("piece_nr", F.substr("piece", F.col("again") + 1).alias("new"))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["new"]), "").alias("text"), F.min("ok").alias("in_limits"))
