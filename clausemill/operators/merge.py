"""Short neighbouring segments merged into longer ones, in a document's order.

The rule carries a growing length from segment to segment, which no window expresses: it is a fold. Partitions are sorted
by document and position and folded in one pass; only the run being merged is held, whatever a document's size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_CHARS, ENOUGH_CHARS = 1800, 200
MERGED_TYPES, ENDINGS = ("NORM", "INFORM"), (".", ";", ":")
_COLUMNS = ["doc", "pos", "id", "type", "page", "section", "text", "keywords", "n_merged"]
_TYPE, _SECTION, _TEXT, _KEYWORDS, _MERGED = 3, 5, 6, 7, 8


def fold(rows: Iterable[tuple], most: int = MOST_CHARS, enough: int = ENOUGH_CHARS) -> Iterator[list]:
    """Merged rows of rows in order; a row is closed once the next can't join it."""
    held: list | None = None
    for r in rows:
        text = r[_TEXT] or ""
        words = list(r[_KEYWORDS]) if r[_KEYWORDS] is not None else []
        joins = held is not None and (held[0], held[_TYPE], held[_SECTION]) == (r[0], r[_TYPE], r[_SECTION]) and len(held[_TEXT]) + 1 + len(text) <= most
        if joins:
            held[_TEXT] = f"{held[_TEXT].rstrip()} {text.strip()}"
            held[_KEYWORDS] += [w for w in words if w not in held[_KEYWORDS]]
            held[_MERGED] += 1
        else:
            if held is not None:
                yield held
            held = [*r[:_TEXT], text, words, 1]
        if held[_TYPE] not in MERGED_TYPES or len(held[_TEXT]) >= enough and held[_TEXT].rstrip().endswith(ENDINGS):
            yield held
            held = None
    if held is not None:
        yield held


def merge_short(segments: DataFrame) -> DataFrame:
    """segments (doc, pos, id, type, page, section, text, keywords) with runs of short neighbours merged.

    Merged are neighbours of one type and section, up to MOST_CHARS; a run is closed early at ENOUGH_CHARS and a closing
    mark. The first fragment gives id and page; keywords are united in order.
    """
    kinds = dict(segments.dtypes)
    schema = f"doc {kinds['doc']}, pos {kinds['pos']}, id string, type string, page int, section string, text string, keywords array<string>, n_merged int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(b[c].astype(object).where(b[c].notna(), None) if c == "page" else b[c] for c in _COLUMNS[:-1]))

        out: list[list] = []
        for r in fold(rows()):
            r[_TEXT] = r[_TEXT].strip()
            out.append(r)
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out = []
        yield pd.DataFrame(out, columns=_COLUMNS)

    rows = segments.select(*_COLUMNS[:-1]).withColumn("section", F.coalesce("section", F.lit("")))
    return rows.repartition("doc").sortWithinPartitions("doc", "pos").mapInPandas(run, schema)


def merge_statistics(segments: DataFrame, most: int = MOST_CHARS, enough: int = ENOUGH_CHARS) -> DataFrame:
    """(before_n, after_n, before_median, after_median, ended_share) of normative and informative rows: what merging does.

    ended_share is the share of merged rows that were closed by a mark at a sufficient length, and not by their neighbours.
    """
    kept = lambda df: df.where(F.col("type").isin(*MERGED_TYPES))
    n = F.length("text")
    ended = (n >= enough) & F.col("text").rlike(r"[.;:]\s*$")
    before = kept(segments).where("text IS NOT NULL").agg(F.count("*").alias("before_n"), F.median(n).alias("before_median"))
    after = kept(merge_short(segments)).agg(F.count("*").alias("after_n"), F.median(n).alias("after_median"), F.avg(ended.cast("int")).alias("ended_share"))
    return before.join(F.broadcast(after)).select("before_n", "after_n", "before_median", "after_median", "ended_share")
