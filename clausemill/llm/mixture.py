"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree over blocks.

Documents are hashed into blocks of their source, so a source's permuted order is an order of blocks, whatever its size,
and only block sums (at most MAX_BLOCKS a source, of a fixed list of sources) reach the driver. A source gets a token
quota; whole passes over its blocks and a last, partial one fill it. The quotas in blocks are then split exactly among
the output shards: at each node of a binary tree over the shards, the left half draws its number of blocks without
replacement, source by source. Every shard so gets disjoint runs of each source's permuted blocks, and is shuffled by a
hash within itself.

Defined results: sources are compared trimmed and lower-cased; null or unlisted sources and null or empty texts aren't
mixed; without a given total, it's the largest at which every source that has documents reaches its share of what the
present sources hold together; with one, sources without enough tokens stay below their share; a source without
documents is reported with 0; a source listed twice counts with its larger entry; repeated rows are documents of their
own; empty tables give an empty mix and a report of zeros; further columns are ignored. The last document that a quota
needs is taken whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clausemill.plans.session import materialize

VOCABULARY = os.environ.get("CLAUSEMILL_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
MAX_BLOCKS = 4096
#: Fixed value: the vocabulary's splitting pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CACHE = 300_000


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary file, a fixed one of about a megabyte; only the driver needs to have it."""
    with open(path, "rb") as f:
        return f.read()


class TokenCounter:
    """Exact token counts: pieces of the splitting pattern are tokenized once and then looked up."""

    def __init__(self, vocabulary: bytes | None = None):
        import tiktoken

        lines = (read_vocabulary() if vocabulary is None else vocabulary).splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(PATTERN)
        self.seen: dict[str, int] = {}

    def __call__(self, text: str) -> int:
        seen, n = self.seen, 0
        for piece in self.pieces.findall(text):
            k = seen.get(piece)
            if k is None:
                k = len(self.encoding.encode_ordinary(piece))
                if len(seen) > _CACHE:
                    seen.clear()
                if len(piece) < 64:
                    seen[piece] = k
            n += k
        return n


def with_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens) of the documents that have text; only sizes leave the Python workers."""
    kind = dict(docs.dtypes)["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = TokenCounter(sent.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "tokens": [count(t) for t in b["text"]]})

    rows = docs.where(F.length("text") > 0).select(F.col("doc_id").cast("string").alias("doc_id"), _name("source").alias("source"), "text").where(F.col("source").isNotNull())
    # keys travel as strings: pandas would turn whole numbers beside nulls into floats
    return rows.mapInPandas(run, "doc_id string, source string, tokens long").withColumn("doc_id", F.col("doc_id").cast(kind))


def _name(c: str):
    return F.lower(F.trim(F.col(c)))


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """A (shards, sources) table of block counts whose columns sum to quotas, drawn down a binary tree of the shards."""
    out = np.zeros((shards, quotas.size), np.int64)
    stack = [(0, shards, quotas.astype(np.int64))]
    while stack:
        low, high, q = stack.pop()
        if high - low == 1:
            out[low] = q
            continue
        mid = (low + high) // 2
        total = int(q.sum())
        left = rng.multivariate_hypergeometric(q, total * (mid - low) // (high - low), method="marginals")
        stack += [(low, mid, left), (mid, high, q - left)]
    return out


def plan(blocks: pd.DataFrame, targets: pd.DataFrame, total: int | None, shards: int, seed: int) -> tuple[pd.DataFrame, dict[str, float]]:
    """Block copies to take: (source, block, copy, shard, fill), fill being the share of the block's tokens; and quotas."""
    have = blocks.groupby("source")["tokens"].sum()
    t = targets.set_index("source")
    t = t[t.index.isin(have.index) & (t["target_share"] > 0)]
    quotas: dict[str, float] = {}
    if len(t):
        most = have.loc[t.index] * t["max_repeats"]
        share = t["target_share"] / t["target_share"].sum()
        size = float((most / share).min()) if total is None else float(total)
        quotas = {s: min(float(most[s]), size * float(share[s])) for s in t.index}
    rng = np.random.default_rng(seed)
    taken, names = [], sorted(quotas)
    for s in names:
        own = blocks[blocks["source"] == s].sort_values("block")
        own = own.iloc[rng.permutation(len(own))]
        b, k = own["block"].to_numpy(), own["tokens"].to_numpy(np.int64)
        passes = max(1, int(np.ceil(quotas[s] / max(1, k.sum()) - 1e-12)))
        ends = np.cumsum(np.tile(k, passes))
        used = min(int(np.searchsorted(ends, quotas[s] - 1e-6)) + 1, ends.size)
        fill = np.ones(used)
        fill[-1] = (quotas[s] - (ends[used - 1] - np.tile(k, passes)[used - 1])) / max(1, np.tile(k, passes)[used - 1])
        taken.append(pd.DataFrame({"source": s, "block": np.tile(b, passes)[:used], "copy": np.repeat(np.arange(passes), b.size)[:used], "fill": np.clip(fill, 0, 1)}))
    if not taken:
        return pd.DataFrame({"source": [], "block": [], "copy": [], "fill": [], "shard": []}), quotas
    counts = split_quotas(np.array([len(x) for x in taken]), shards, rng)
    for i, x in enumerate(taken):
        x["shard"] = np.repeat(np.arange(shards), counts[:, i])
    return pd.concat(taken, ignore_index=True), quotas


def _planned(docs: DataFrame, targets: DataFrame, total: int | None, shards: int, seed: int, vocabulary: str):
    spark = docs.sparkSession
    wanted = (
        targets.where(F.col("source").isNotNull())
        .groupBy(_name("source").alias("source"))
        .agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        .toPandas()
    )
    rows = with_tokens(docs.where(_name("source").isin(wanted["source"].tolist())), vocabulary)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(MAX_BLOCKS)).cast("int"))
    sized = materialize(rows, "mixture-sizes")
    blocks = sized.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")).toPandas()
    taken, _ = plan(blocks, wanted, total, shards, seed)
    part = spark.createDataFrame([tuple(x) for x in taken[["source", "block", "copy", "fill", "shard"]].itertuples(index=False)], "source string, block int, copy int, fill double, shard int")
    return wanted, sized, part


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, shards: int = 64, seed: int = 7, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, place, doc_id, copy, source, tokens): the mix; place orders a shard, copy counts a document's uses from 0."""
    _, sized, part = _planned(docs, targets, total, shards, seed, vocabulary)
    return _taken(sized, part, seed).select("shard", F.xxhash64(F.lit(seed), "shard", "doc_id", "copy").alias("place"), "doc_id", "copy", "source", "tokens")


def _taken(sized: DataFrame, part: DataFrame, seed: int) -> DataFrame:
    """The documents of the planned block copies. Only a quota's last block is cut, by tokens in a hashed order."""
    whole = sized.join(F.broadcast(part.where("fill >= 1")), ["source", "block"])
    last = sized.join(F.broadcast(part.where("fill < 1")), ["source", "block"])
    run = Window.partitionBy("source", "block", "copy").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "tokens")
    every = Window.partitionBy("source", "block", "copy")
    cut = last.withColumn("before", F.sum("tokens").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")).withColumn("all", F.sum("tokens").over(every))
    return whole.drop("fill").unionByName(cut.where(F.col("before") < F.col("fill") * F.col("all")).drop("before", "all", "fill"))


def mix_report(docs: DataFrame, targets: DataFrame, total: int | None = None, shards: int = 64, seed: int = 7, vocabulary: str = VOCABULARY) -> DataFrame:
    """(source, target_share, max_repeats, tokens_available, largest, tokens_mixed, repeats, actual_share) of every listed
    source; largest is the size of its largest document, by which a quota may be exceeded."""
    wanted, sized, part = _planned(docs, targets, total, shards, seed, vocabulary)
    listed = docs.sparkSession.createDataFrame([tuple(x) for x in wanted.itertuples(index=False)], "source string, target_share double, max_repeats int")
    have = sized.groupBy("source").agg(F.sum("tokens").alias("tokens_available"), F.max("tokens").alias("largest"))
    got = _taken(sized, part, seed).groupBy("source").agg(F.sum("tokens").alias("tokens_mixed"), (F.max("copy") + 1).alias("repeats"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = listed.join(have, "source", "left").join(got, "source", "left").select("source", "target_share", "max_repeats", zero("tokens_available"), zero("largest"), zero("tokens_mixed"), zero("repeats"))
    return out.withColumn("actual_share", F.col("tokens_mixed") / F.greatest(F.sum("tokens_mixed").over(Window.partitionBy()), F.lit(1)))


def shard_report(docs: DataFrame, targets: DataFrame, total: int | None = None, shards: int = 64, seed: int = 7, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, source, tokens, share): what each shard holds of each source, and its share of the shard.

    Shards get exact numbers of blocks, drawn as the tree draws them, so their shares stray about those of the whole mix, the
    less the more blocks a shard has of a source.
    """
    _, sized, part = _planned(docs, targets, total, shards, seed, vocabulary)
    per = _taken(sized, part, seed).groupBy("shard", "source").agg(F.sum("tokens").alias("tokens"))
    return per.withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy("shard")))


def mix_checks(report: DataFrame, near: float = 0.01) -> DataFrame:
    """(source, in_caps, near_target) of a report: no source beyond its repeats, and each near its share of what is present,
    but for the documents by which it and the others exceed their quotas."""
    everything = Window.partitionBy()
    present = F.when(F.col("tokens_available") > 0, F.col("target_share")).otherwise(0.0)
    share, total = present / F.greatest(F.sum(present).over(everything), F.lit(1e-12)), F.sum("tokens_mixed").over(everything)
    caps = (F.col("repeats") <= F.col("max_repeats")) & (F.col("tokens_mixed") <= F.col("tokens_available") * F.col("max_repeats"))
    close = F.abs(F.col("tokens_mixed") - share * total) <= near * total + F.col("largest") + share * F.sum("largest").over(everything)
    return report.select("source", caps.alias("in_caps"), close.alias("near_target"))
