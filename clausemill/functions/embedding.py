"""Embeddings without a server: signed hashing of words, unit length. A drop-in for a served model in tests and offline.

A word's md5 gives its place and sign, so that any engine can work the same vectors out. A served model comes in as a
function of a list of texts; `embedder` calls it in batches, tries again with growing pauses and gives null where it fails.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, FloatType

DIMENSIONS, BATCH = 64, 16
_WORD = re.compile(r"[^\W_]+")
_CACHE = 400_000


class _Places(dict):
    def __missing__(self, word: str) -> tuple[int, int]:
        h = hashlib.md5(word.encode()).hexdigest()
        if len(self) > _CACHE:
            self.clear()
        self[word] = out = (int(h[:2], 16) % DIMENSIONS, 1 if h[2] in "01234567" else -1)
        return out


def hashed(text: str | None, places: _Places | None = None) -> np.ndarray:
    v, places = np.zeros(DIMENSIONS), _Places() if places is None else places
    for w in _WORD.findall((text or "").lower()):
        at, sign = places[w]
        v[at] += sign
    return (v / max(np.sqrt(v @ v), 1e-12)).astype(np.float32)


@pandas_udf(ArrayType(FloatType()))
def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    places = _Places()
    for b in batches:
        yield pd.Series([hashed(t, places) for t in b])


def embedder(model: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]], batch: int = BATCH, tries: int = 3, pause: float = 0.5) -> Callable[[Column], Column]:
    """A column function over a served model. `model` is called once a task and gives the function that embeds a list."""

    @pandas_udf(ArrayType(FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ask = model()
        for b in batches:
            out: list = []
            for i in range(0, len(b), batch):
                texts = [t or "" for t in b.iloc[i : i + batch]]
                got: Sequence | None = None
                for k in range(tries):
                    try:
                        got = ask(texts)
                        break
                    except OSError:
                        time.sleep(pause * (k + 1))
                out += [np.asarray(v, np.float32) for v in got] if got is not None and len(got) == len(texts) else [None] * len(texts)
            yield pd.Series(out)

    return run


def missing(segments: DataFrame) -> DataFrame:
    """The rows still to be embedded."""
    return segments.where(F.col("type").isin("NORM", "INFORM") & (F.coalesce("has_embedding", F.lit(0)) == 0) & (F.trim(F.coalesce("text", F.lit(""))) != ""))


def embed_missing(segments: DataFrame) -> DataFrame:
    """(row_nr, embedding) of the rows still to be embedded."""
    return missing(segments).select("row_nr", embed("text").alias("embedding"))


def packed(vector: Column) -> Column:
    """A vector as little-endian 32-bit floats, as stores of other engines hold it; null stays null."""

    @pandas_udf("binary")
    def pack(b: pd.Series) -> pd.Series:
        return b.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())

    return pack(vector)


def unpacked(blob: Column) -> Column:
    @pandas_udf(ArrayType(FloatType()))
    def unpack(b: pd.Series) -> pd.Series:
        return b.map(lambda v: None if v is None else np.frombuffer(v, "<f4"))

    return unpack(blob)


def answered(model: Callable[[], Callable[[str], str]], default: str | None = None) -> Callable[[Column], Column]:
    """A column function over a model that answers a prompt; `default` where it fails or there is no prompt.

    Equal prompts of a task are asked once. Titles, headings and boundaries between blocks are all asked for so."""

    @pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ask, known = model(), {}
        for b in batches:
            for p in set(b.dropna()) - set(known):
                try:
                    known[p] = ask(p)
                except OSError:
                    known[p] = default
            yield b.map(lambda p: known.get(p, default) if p is not None else default)
            if len(known) > _CACHE:
                known = {}

    return run


def first_backend(candidates: Sequence[tuple[str, Callable[[], bool]]]) -> str | None:
    """The first of the named backends whose probe says that it's there; null if none is. Ask once, on the driver."""
    for name, probe in candidates:
        try:
            if probe():
                return name
        except OSError:
            continue
    return None
