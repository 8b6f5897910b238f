"""Near-duplicate texts with small edits: an exact prefix join on shingles, pruned by parity bitmaps, and verification.

Two texts are near when they have half of either's shingles in common. If all shingles have one order, such texts share
one of the first n - ceil(n / 2) + 1 of either (the prefix), so that an equality join over prefixes misses no pair. Rare
shingles come first, by a frequency sketch of all classes' shingles, which only makes the join smaller: any order is exact.

A class is sent once to each group of keys that its prefix has keys of, with a bitmap in which each shingle flips one
bit. The bits in which two bitmaps differ are at most the shingles in which the sets do, so that a pair whose bitmaps
differ too much is dropped safely, where it is found; the rest is verified on full shingle sets.

Most pairs meet under frequent keys, which stand late in their texts' order. If such a key is the first that two texts
have in common, then all that they share comes from there on, and is most of what is left. So a frequent key carries a
bitmap of its text's shingles from there on, of 64 or 128 bits, which drops nearly all of its pairs at a fraction of the
cost. A pair is only dropped under a key that isn't the first in common, or if it isn't near; near ones stay at the first.

What is sent to the groups is bounded by taking these in rounds, once there are more of them than run at a time.

Texts with the same shingle set form a class, and only classes are joined, so copies cost no pairs. The sketch is a table
of at most 2^22 counts whatever the data, summed by cell across tasks; it's all that passes through the driver. The join
grows with the pairs that share a prefix shingle: with the square of a group of texts made of the same phrases.

Defined results: null and short texts have no partner; a null type is neither NORM nor INFORM; null ids are equal to one
another; repeated rows are copies; empty tables give empty results; further columns are ignored. Shingles are compared
by 32-bit hashes, at which two unequal ones of a pair coincide with a chance of about one in a million.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import free_shuffles, materialize

SHINGLE, MIN_WORDS = 3, 30
#: Classes of a key that one task joins, and pairs that are compared at once.
HOT_CLASSES, PAIRS = 20_000, 200_000
#: Classes of a key from which it carries 64 and 128 bits of what follows it; postings of a key that are compared as blocks, and the blocks' sides.
TAILS, LONG_LIST, BLOCK = (50, 1_000), 48, (64, 2_048)
#: Bytes that one task joins, and bytes a text that are sent in one round, both as estimated; bits for the number of a text among those indexed at once.
GROUP_BYTES, ROUND_BYTES, DOC_BITS = 80_000_000, 1_500, 14
_WORD = re.compile(r"[^\W_]+")
_CACHE = 400_000
_MUL, _MUL32 = np.uint64(0x9E3779B97F4A7C15), np.uint32(0x9E3779B1)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) > _CACHE:
            self.clear()
        self[word] = h
        return h


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(parts[0].shape, 0x2545F4914F6CDD1D, np.uint64)
    for p in parts:
        h = (h ^ p) * _MUL
        h ^= h >> np.uint64(31)
    return h


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, 40 bits of h) in that order. A batch has less than 2^24 texts, so both fit one sorted word."""
    x = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    new = np.ones(x.size, bool)
    new[1:] = x[1:] != x[:-1]
    x = x[new]
    return (x >> np.uint64(40)).astype(np.int64), x & np.uint64((1 << 40) - 1)


class Batch:
    """The eligible texts of an Arrow batch, as one array of word hashes."""

    def __init__(self, texts: list[str], hashes: _Hashes, shingle: int = SHINGLE, min_words: int = MIN_WORDS):
        words = [_WORD.findall(t.lower()) for t in texts]
        self.rows = np.array([i for i, w in enumerate(words) if len(w) >= max(min_words, shingle)], np.int64)
        words = [words[i] for i in self.rows]
        self.size = np.array([len(w) for w in words], np.int64)
        n = int(self.size.sum())
        self.h = np.fromiter((hashes[w] for ws in words for w in ws), np.uint64, n)
        self.doc = np.repeat(np.arange(self.size.size), self.size)
        self.left = np.repeat(np.cumsum(self.size), self.size) - np.arange(n)  # words from here to the text's end

        at = np.flatnonzero(self.left >= shingle)
        self.sdoc, self.shingles = _distinct(self.doc[at], _fold([self.h[at + k] for k in range(shingle)]))
        self.count = np.bincount(self.sdoc, minlength=self.size.size)

    def classes(self) -> np.ndarray:
        """A 64-bit id of each text's shingle set."""
        ends = np.cumsum(self.count)
        raw = self.shingles.tobytes()
        return np.array([xxhash.xxh3_64_intdigest(raw[8 * (e - c) : 8 * e]) for e, c in zip(ends.tolist(), self.count.tolist())], np.uint64).view(np.int64)


def _lists(doc: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _fresh(c: np.ndarray, done: set[int]) -> np.ndarray:
    return np.array([v not in done and not done.add(v) for v in c.tolist()], bool)


def _common(n: np.ndarray, least: float) -> np.ndarray:
    """Shingles that a set of n must have in common with any near one, at least 1."""
    return np.maximum(1, np.ceil(least * n - 1e-9)).astype(np.int64)


def _bitmaps(doc: np.ndarray, keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit words, how many are each set's): bitmaps of 6 to 12 bits a shingle, each shingle flipping one bit."""
    size = np.array([max(1, 1 << (int(n) * 6 - 1).bit_length() >> 6) for n in count], np.int64)
    words = np.zeros(int(size.sum()), np.uint64)
    at = (keys.astype(np.uint64) * _MUL) >> np.uint64(32)
    word = (at >> np.uint64(6)).astype(np.int64) & (size[doc] - 1)
    np.bitwise_xor.at(words, (np.cumsum(size) - size)[doc] + word, np.uint64(1) << (at & np.uint64(63)))
    return words, size


def _apart(x: np.ndarray) -> np.ndarray:
    """Bits set in each row of x, whose width is a power of two; bytes are added up eight at a time."""
    c = np.bitwise_count(x)
    if c.shape[1] < 8:
        return c.sum(1, dtype=np.int64)
    c = c.view(np.uint64)
    low = np.uint64(0x00FF00FF00FF00FF)
    c = ((c & low) + ((c >> np.uint64(8)) & low)) * np.uint64(0x0001000100010001) >> np.uint64(48)
    return (c[:, 0] if c.shape[1] == 1 else c.sum(1, dtype=np.uint64)).astype(np.int64)


def _joined(batches: list[pa.RecordBatch], name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column over several batches."""
    lists = [b.column(name) for b in batches]
    size = np.concatenate([np.diff(v.offsets.to_numpy()) for v in lists])
    return np.concatenate([v.flatten().to_numpy(zero_copy_only=False) for v in lists]), np.concatenate(([0], np.cumsum(size, dtype=np.int64)))


_PARTS = (("c", np.int64), ("words", np.uint64), ("size", np.int32), ("n", np.int32), ("each", np.int32), ("keys", np.uint32), ("places", np.uint8), ("wide", np.uint8), ("tails", np.uint64))


def _packed(**parts: np.ndarray) -> bytes:
    """Postings of one group of keys as one value: a row for each class would be more overhead than content.

    Bytes of one rank stand together: the high ones of small numbers are zero and are compressed away. `wide` and `tails`
    may be absent."""
    none = np.empty(0, np.uint8)
    planes = [np.ascontiguousarray(parts.get(k, none), t).view(np.uint8).reshape(-1, np.dtype(t).itemsize).T for k, t in _PARTS]
    return b"".join([np.array([x.shape[1] for x in planes], np.int64).tobytes(), *[x.tobytes() for x in planes]])


def _unpacked(blobs: list[bytes]) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in _PARTS]
    for b in blobs:
        at = 8 * len(_PARTS)
        for (_, t), n, to in zip(_PARTS, np.frombuffer(b, np.int64, len(_PARTS)).tolist(), out):
            width = np.dtype(t).itemsize
            to.append(np.ascontiguousarray(np.frombuffer(b, np.uint8, n * width, at).reshape(width, n).T).view(t).ravel())
            at += n * width
    return [np.concatenate(x) for x in out]


def _tails(keys: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each place of each ordered set, parities of the shingles from there on: of 64 bits, and of half of 128.

    The other half is where these two differ."""
    at = (keys.astype(np.uint64) * _MUL) >> np.uint64(40)
    bit = np.uint64(1) << (at & np.uint64(63))
    bits = np.stack((bit, np.where(at & np.uint64(64), bit, np.uint64(0))), 1)
    sums = np.concatenate((np.zeros((1, 2), np.uint64), np.bitwise_xor.accumulate(bits, 0)))
    return sums[:-1] ^ np.repeat(sums[begin + count], count, 0)


def _alike(key: np.ndarray, n: np.ndarray, limit: np.ndarray, first: np.ndarray, rest: np.ndarray, spare: np.ndarray, wide: np.ndarray, tails: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Postings (x, y) of one key, at most `step` at a time, that can be near by size and by what follows the key.

    They are sorted by key and size; x is the smaller, and one of `first`."""
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: key.size])
    size = np.diff(np.append(begin, key.size))
    one, two = tails[:, 0].copy(), tails[:, 1].copy()
    bits = np.minimum.reduceat(wide, begin) if begin.size else wide

    def left(x: np.ndarray, y: np.ndarray, level: np.ndarray | int) -> np.ndarray:
        half = two[x] ^ two[y]
        apart = np.bitwise_count(half) + np.bitwise_count(half ^ one[x] ^ one[y])
        return (level < 2) | (apart <= rest[x] + spare[y])

    def cut(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for j in range(0, x.size, step):
            yield x[j : j + step], y[j : j + step]

    # short lists: each posting beside the next, the one after that, and so on
    level = np.repeat(bits, size)
    i, d = np.flatnonzero(first & np.repeat(size < LONG_LIST, size)), 0
    while True:
        d += 1
        i = i[: np.searchsorted(i, key.size - d)]
        i = i[(key[i] == key[i + d]) & (n[i + d] <= limit[i])]
        if not i.size:
            break
        x = i[(level[i] < 1) | (np.bitwise_count(one[i] ^ one[i + d]) <= rest[i] + spare[i + d])]
        x = x[left(x, x + d, level[x])]
        yield from cut(x, x + d)

    # long lists: blocks of postings by postings
    xs, ys, held = [], [], 0
    rows, columns = BLOCK
    for s, e, w in zip(begin[size >= LONG_LIST].tolist(), (begin + size)[size >= LONG_LIST].tolist(), bits[size >= LONG_LIST].tolist()):
        stop = s + int(np.count_nonzero(first[s:e]))  # these are the smallest of the list
        for p in range(s, stop, rows):
            q = min(p + rows, stop)
            end = s + int(np.searchsorted(n[s:e], limit[p:q].max(), "right"))
            for u in range(p + 1, end, columns):
                v = min(u + columns, end)
                if w:
                    ok = np.bitwise_count(one[p:q, None] ^ one[None, u:v]) <= rest[p:q, None] + spare[None, u:v]
                else:
                    ok = np.ones((q - p, v - u), bool)
                at = np.flatnonzero(ok)
                x, y = p + at // (v - u), u + at % (v - u)
                ok = (x < y) & (n[y] <= limit[x])
                x, y = x[ok], y[ok]
                if w > 1:
                    ok = left(x, y, w)
                    x, y = x[ok], y[ok]
                xs.append(x)
                ys.append(y)
                held += x.size
                if held >= step:
                    yield from cut(np.concatenate(xs), np.concatenate(ys))
                    xs, ys, held = [], [], 0
    if held:
        yield from cut(np.concatenate(xs), np.concatenate(ys))


def _meetings(blobs: list[bytes], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(smaller, larger) classes that share a key where both can still be near, and whose bitmaps don't rule that out."""
    if not blobs:
        return
    c, words, size, n, each, keys, places, wide, sent = _unpacked(blobs)
    blobs.clear()
    if wide.size != keys.size:
        wide = np.zeros(keys.size, np.uint8)
    tails, begin = np.zeros((keys.size, 2), np.uint64), np.cumsum(wide, dtype=np.int64) - wide
    for k in (0, 1):
        tails[wide > k, k] = sent[begin[wide > k] + k]
    key, size, each = keys.astype(np.int64), size.astype(np.int64), each.astype(np.int64)
    begin = np.cumsum(size) - size

    # classes in order of their size, once each; what other tasks or groups sent again is the same
    o = np.lexsort((c, n))
    new = np.ones(o.size, bool)
    new[1:] = c[o][1:] != c[o][:-1]
    rank = np.empty(o.size, np.int64)
    rank[o] = np.cumsum(new) - 1
    o = o[new]
    rank = np.repeat(rank, each)
    c, n, size, begin = c[o], n[o].astype(np.int64), size[o], begin[o]
    o = np.lexsort((rank, key))
    key, rank = key[o], rank[o]
    new = np.ones(key.size, bool)
    new[1:] = (key[1:] != key[:-1]) | (rank[1:] != rank[:-1])
    o = o[new]
    key, rank, places, wide, tails = key[new], rank[new], places[o], wide[o], tails[o]
    # from its place on, a set has so few shingles left that a set larger than this can't be near if this key is the first in common
    n_mine = n[rank]
    rest = n_mine - -(-places.astype(np.int64) * n_mine // 256)
    limit = np.floor(rest / least + 1e-9).astype(np.int64)
    # shingles from the first in common on, in which a near pair may differ: `rest` of the smaller set and `spare` of the larger
    spare = rest - 2 * _common(n_mine, least)
    if not n.size or n[-1] < 8_000:
        rest, spare = rest.astype(np.int16), spare.astype(np.int16)

    for w in np.unique(size):
        lo, hi = np.searchsorted(size, [w, w + 1])
        top = int(np.searchsorted(n, n[hi - 1] / least, "right"))
        maps = np.empty((top - lo, w), np.uint64)
        for v in np.unique(size[lo:top]):  # wider bitmaps are folded: their parities add up
            at = lo + np.flatnonzero(size[lo:top] == v)
            for part in np.array_split(at, max(1, at.size * v // 4_000_000)):
                maps[part - lo] = np.bitwise_xor.reduce(words[begin[part][:, None] + np.arange(v)].reshape(-1, v // w, w), 1)
        mine = (rank >= lo) & (rank < top)
        k, r = key[mine], rank[mine]
        found, held = [], 0
        for x, y in _alike(k, n[r], limit[mine], r < hi, rest[mine], spare[mine], wide[mine], tails[mine], max(1, PAIRS * 8 // int(w))):
            a, b = r[x], r[y]
            near = n[a] + n[b] - _apart(maps[a - lo] ^ maps[b - lo]) >= 2 * _common(n[b], least)
            found.append(a[near] << 32 | b[near])
            held += found[-1].size
            if held > 2_000_000:
                pair = np.unique(np.concatenate(found))
                yield c[pair >> 32], c[pair & 0xFFFFFFFF]
                found, held = [], 0
        if held:
            pair = np.unique(np.concatenate(found))
            yield c[pair >> 32], c[pair & 0xFFFFFFFF]


def sketch_width(n_rows: int) -> int:
    return 1 << min(22, max(10, (max(1, n_rows) - 1).bit_length()))


def _summed(t: pa.Table) -> pa.Table:
    """One block of the sketch: the sum of all tasks' counts."""
    total = np.sum([np.asarray(v.values, np.int64) for v in t.column("cells")], 0)
    return pa.table({"block": t.column("block")[:1], "counts": pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())})


def _split(doc: np.ndarray, keys: np.ndarray, c: np.ndarray, freq: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(which posting, its key): postings of hot keys once for every pair of blocks that their class's block is in, so that
    no key is one task's alone.

    Of a key that may have more than `most` classes, these fall into blocks by their id; any two classes meet under the
    pair of their blocks."""
    blocks = -(-freq.astype(np.int64) // most)
    hot = np.flatnonzero(blocks > 1)
    if not hot.size:
        return np.arange(keys.size), keys
    at = np.repeat(hot, blocks[hot])
    other = np.arange(at.size) - np.repeat(np.cumsum(blocks[hot]) - blocks[hot], blocks[hot])
    own = (c[doc[at]].view(np.uint64) % blocks[at].astype(np.uint64)).astype(np.int64)
    pair = np.minimum(own, other) << 32 | np.maximum(own, other)
    mixed = _fold([keys[at].astype(np.uint64), pair.astype(np.uint64)]) >> np.uint64(32)
    cold = np.flatnonzero(blocks <= 1)
    return np.concatenate((cold, at)), np.concatenate((keys[cold], mixed.astype(np.uint32)))


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of begin[i] .. begin[i] + size[i] - 1, one range after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _posts(c: np.ndarray, keys: np.ndarray, count: np.ndarray, freq: np.ndarray, least: float, hot: int, groups: int, part: int = 0, parts: int = 1) -> tuple[np.ndarray, list[bytes]]:
    """(groups, their postings) of at most 2^DOC_BITS classes with their sets one after the other; only groups of this part, numbered anew."""
    doc, begin = np.repeat(np.arange(count.size), count), np.cumsum(count) - count
    words, size = _bitmaps(doc, keys, count)
    # one sorted word holds the order: text, frequency (of which the leading bits count), key
    often = freq[(keys % np.uint32(freq.size)).astype(np.int64)]
    level = (np.maximum(often, 1).astype(np.float32).view(np.uint32) - np.uint32(127 << 23)) >> np.uint32(DOC_BITS - 3)
    word = np.sort(doc.astype(np.uint64) << np.uint64(64 - DOC_BITS) | level.astype(np.uint64) << np.uint64(32) | keys)
    keys = (word & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    tails = _tails(keys, begin, count)
    place = np.arange(doc.size) - begin[doc]
    kept = np.flatnonzero(place <= (count - _common(count, least))[doc])
    often = freq[(keys[kept] % np.uint32(freq.size)).astype(np.int64)]
    at, keys = _split(doc[kept], keys[kept], c, often, hot)
    group = ((keys * _MUL32) >> np.uint32(7)) % np.uint32(groups)
    mine = np.flatnonzero(group % np.uint32(parts) == part)
    group = group[mine] // np.uint32(parts)
    # by group and text
    at = at[mine]
    o = np.lexsort((doc[kept][at], group))
    group, keys, at = group[o], keys[mine][o], at[o]
    wide = np.searchsorted(TAILS, often[at], "right").astype(np.uint8)
    at = kept[at]
    doc, place, tails = doc[at], place[at] * 256 // count[doc[at]], tails[at]
    new = np.ones(doc.size, bool)
    new[1:] = (doc[1:] != doc[:-1]) | (group[1:] != group[:-1])
    begins = np.flatnonzero(new)
    of, each, doc = group[begins], np.diff(np.append(begins, doc.size)), doc[begins]
    words = words[_ranges((np.cumsum(size) - size)[doc], size[doc])]
    tails = tails[np.arange(2) < wide[:, None]]
    which, start = np.unique(of, return_index=True)
    end = np.append(start, of.size)[1:]
    sums = lambda x: np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
    key_at, word_at, tail_at = sums(each), sums(size[doc]), sums(wide)
    blobs = []
    for s, e in zip(start.tolist(), end.tolist()):
        k = slice(key_at[s], key_at[e])
        blobs.append(_packed(c=c[doc[s:e]], words=words[word_at[s] : word_at[e]], size=size[doc[s:e]], n=count[doc[s:e]], each=each[s:e], keys=keys[k], places=place[k], wide=wide[k], tails=tails[tail_at[k.start] : tail_at[k.stop]]))
    return which.astype(np.int32), blobs


def _layout(texts: int, shingles: float, cores: int, least: float) -> tuple[int, int]:
    """(groups of keys, rounds in which these are taken). A text is sent to each group that one of its keys falls into, with a
    bitmap each time, so that more groups make more bytes."""
    keys = (1 - least) * shingles + 1
    groups = cores
    for _ in range(20):
        sent = groups * (1 - (1 - 1 / groups) ** keys) * (20 + 9 / 8 * shingles) + 22 * keys
        groups = max(groups, int(-(-texts * sent // GROUP_BYTES)))
    return groups, int(max(1, min(groups // cores, -(-sent // ROUND_BYTES))))


def link_classes(rows: DataFrame, shingle: int = SHINGLE, min_words: int = MIN_WORDS, least: float = 0.5, hot: int = HOT_CLASSES, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """members (row_nr, id, c, n): each eligible row's class; links (a, b): pairs of classes, each once, with at least the
    share `least` of either's shingles in common."""
    texts = rows.where(F.length("text") > 0).select("row_nr", "id", "text")
    kinds = dict(texts.dtypes)
    n_texts = texts.count()
    width = sketch_width(n_texts)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, cells, done = _Hashes(), np.zeros(width, np.int64), set()
        for b in batches:
            x = Batch(b.column("text").to_pylist(), hashes, shingle, min_words)
            c, keys = x.classes(), x.shingles.astype(np.uint32)
            fresh = _fresh(c, done)
            cells += np.bincount((keys[fresh[x.sdoc]] % np.uint32(width)).astype(np.int64), minlength=width)
            k = b.take(pa.array(x.rows))
            sets = _lists(x.sdoc, keys.view(np.int32), x.rows.size).take(pa.array(np.where(fresh, np.arange(fresh.size), -1), mask=~fresh))
            none = pa.nulls(x.rows.size, pa.int32()), pa.nulls(x.rows.size, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([k.column("row_nr"), k.column("id"), pa.array(c), pa.array(x.count.astype(np.int32)), sets, *none], ["row_nr", "id", "c", "n", "s", "block", "cells"])
        if cells.any():
            m = width // 1024
            counts = _lists(np.repeat(np.arange(m), 1024), np.minimum(cells, 2**31 - 1).astype(np.int32), m)
            none = [pa.nulls(m, t) for t in (b.schema.field("row_nr").type, b.schema.field("id").type, pa.int64(), pa.int32(), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(m, dtype=np.int32)), counts], ["row_nr", "id", "c", "n", "s", "block", "cells"])

    schema = f"row_nr {kinds['row_nr']}, id {kinds['id']}, c long, n int, s array<int>, block int, cells array<int>"
    seen = materialize(texts.mapInArrow(first, schema), "near-classes")
    members = seen.where("c IS NOT NULL").select("row_nr", "id", "c", "n")
    full = seen.where("s IS NOT NULL").select("c", "s")
    cells = seen.where("block IS NOT NULL").select("block", "cells").groupBy("block").applyInArrow(_summed, "block int, counts binary").collect()
    table = np.zeros(width, np.uint32)
    for r in cells:
        table[r["block"] * 1024 : (r["block"] + 1) * 1024] = np.frombuffer(r["counts"], np.uint32)
    sketch = rows.sparkSession.sparkContext.broadcast(table)

    eligible, shingles = members.agg(F.count("c"), F.avg("n")).first()
    groups, parts = _layout(eligible, shingles or 0, rows.sparkSession.sparkContext.defaultParallelism, least)
    parts = min(rounds or parts, groups)

    def index(part: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: set[int] = set()
            for b in batches:
                b = b.filter(pa.array(_fresh(b.column("c").to_numpy(), done)))
                for at in range(0, b.num_rows, 1 << DOC_BITS):
                    x = b.slice(at, 1 << DOC_BITS)
                    keys, begin = _joined([x], "s")
                    which, blobs = _posts(x.column("c").to_numpy(), keys.view(np.uint32), np.diff(begin), sketch.value, least, hot, groups, part, parts)
                    yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(blobs, pa.binary())], ["g", "posts"])

        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _meetings([v.as_py() for x in batches for v in x.column("posts")], least):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    pairs = None
    for part in range(parts):
        posts = full.mapInArrow(index(part), "g int, posts binary").repartitionById(-(-groups // parts), F.col("g"))
        # the first of a pair has the smaller set: that one will be moved to the other
        met = materialize(posts.mapInArrow(meet, "a long, b long").distinct(), "near-candidates")
        del posts
        free_shuffles(rows.sparkSession)
        pairs = met if pairs is None else pairs.union(met)
    if parts > 1:
        pairs = pairs.distinct()

    wanted = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    full = full.join(wanted, "c", "left_semi").dropDuplicates(["c"])
    moved = pairs.join(full.select(F.col("c").alias("a"), F.col("s").alias("t")), "a")
    both = moved.join(full.select(F.col("c").alias("b"), "s"), "b")
    links = both.where(F.size(F.array_intersect("s", "t")) >= least * F.greatest(F.size("s"), F.size("t"))).select("a", "b")
    return members, links


def near_pairs(rows: DataFrame, shingle: int = SHINGLE, min_words: int = MIN_WORDS, least: float = 0.5) -> DataFrame:
    """(row_a, row_b), row_a < row_b: all pairs of rows with different id above the threshold, copies included."""
    members, links = link_classes(rows, shingle, min_words, least)
    one = members.select(F.col("c").alias("a"), F.col("row_nr").alias("r1"), F.col("id").alias("i1"))
    two = members.select(F.col("c").alias("b"), F.col("row_nr").alias("r2"), F.col("id").alias("i2"))
    copies = one.join(two, (F.col("a") == F.col("b")) & (F.col("r1") < F.col("r2")))
    across = links.join(one, "a").join(two, "b")
    both = copies.select("r1", "i1", "r2", "i2").unionByName(across.select("r1", "i1", "r2", "i2")).where(~F.col("i1").eqNullSafe(F.col("i2")))
    return both.select(F.least("r1", "r2").alias("row_a"), F.greatest("r1", "r2").alias("row_b")).distinct()


def near_classes(rows: DataFrame, shingle: int = SHINGLE, min_words: int = MIN_WORDS, least: float = 0.5) -> DataFrame:
    """(row_nr, class_id, n_copies, n_links): each eligible row, its class of copies, and how many other classes are near."""
    members, links = link_classes(rows, shingle, min_words, least)
    degree = links.select(F.col("a").alias("c")).unionAll(links.select("b")).groupBy("c").agg(F.count("*").alias("n_links"))
    copies = members.groupBy("c").agg(F.min("row_nr").alias("class_id"), F.count("*").alias("n_copies"))
    return members.select("row_nr", "c").join(copies, "c").join(degree, "c", "left").select("row_nr", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
