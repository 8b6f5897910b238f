"""Lines repeated across one source's documents: found by bitmaps of documents, removed by lookup.

A line's documents are kept as a compressed bitmap per source: documents get dense ordinals in the order of (source,
document), and a bitmap is stored as its non-empty 64-bit words, one row (line, word number, bits) each. Such words are
OR-ed where they arise, before any shuffle, so that a line in a third of all documents moves as a few words of each
task, not as its occurrences. Variants of a line (case, digits, punctuation, spacing) fall on one key, by which their
bitmaps are united with the same OR. Bit counts summed over the words are exact cardinalities. Lines are then deleted
by looking their key up among the keys whose bitmap is large enough.

Keys are two 64-bit hashes of source and letters. Defined results: null texts have no lines; rows with a null source
(norm) belong to no source, so none of their lines is found; rows with a null document (source_file) don't count
towards a line's documents but lose the line if it is found; a null type is no heading; repeated rows count once,
as their document does; empty tables give empty results; further columns of the input pass through removal unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import materialize

HEADINGS = ("SECTION", "TOC")
MIN_LETTERS, MIN_DOCS = 45, 5


def source_lines(rows: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(row_nr, line_nr, norm, source_file, k1, k2) of the lines long enough to be judged."""
    body = rows.where(F.col("text").isNotNull() & F.col("norm").isNotNull() & ~F.coalesce(F.col("type").isin(*HEADINGS), F.lit(False)))
    lines = body.select("row_nr", "norm", "source_file", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(
        F.length("line") >= min_letters
    )
    letters = F.regexp_replace(F.lower("line"), r"[^\p{L}]+", "")
    return (
        lines.select("row_nr", (F.col("pos") + 1).alias("line_nr"), "norm", "source_file", letters.alias("letters"))
        .where(F.length("letters") >= min_letters)
        .select("row_nr", "line_nr", "norm", "source_file", F.xxhash64("norm", "letters").alias("k1"), F.xxhash64(F.lit(1), "letters", "norm").alias("k2"))
    )


def document_ordinals(lines: DataFrame) -> DataFrame:
    """(norm, source_file, ordinal): unique, and dense within the ranges of (norm, source_file). Written once, so it is stable."""
    docs = lines.where(F.col("source_file").isNotNull()).select("norm", "source_file").distinct()
    ranged = docs.repartitionByRange("norm", "source_file").sortWithinPartitions("norm", "source_file")
    return materialize(ranged.withColumn("ordinal", F.monotonically_increasing_id()), "line-documents")


def line_bitmaps(lines: DataFrame, ordinals: DataFrame) -> DataFrame:
    """(k1, k2, word, bits): the non-empty words of every line's bitmap, united over the line's variants."""
    placed = lines.where(F.col("source_file").isNotNull()).select("norm", "source_file", "k1", "k2").join(ordinals, ["norm", "source_file"])
    bit = F.expr("shiftleft(1L, cast(ordinal & 63L AS INT))")
    return placed.groupBy("k1", "k2", F.shiftrightunsigned("ordinal", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def repeated_keys(rows: DataFrame, min_letters: int = MIN_LETTERS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, n_docs) of the lines in at least min_docs documents of their source."""
    lines = source_lines(rows, min_letters)
    bitmaps = line_bitmaps(lines, document_ordinals(lines))
    return bitmaps.groupBy("k1", "k2").agg(F.sum(F.bit_count("bits")).alias("n_docs")).where(F.col("n_docs") >= min_docs)


def find_repeated_lines(rows: DataFrame, min_letters: int = MIN_LETTERS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row_nr, line_nr, norm, n_docs) of every occurrence of a repeated line; line_nr counts from 1."""
    keys = materialize(repeated_keys(rows, min_letters, min_docs), "line-keys")
    return source_lines(rows, min_letters).join(keys, ["k1", "k2"]).select("row_nr", "line_nr", "norm", "n_docs")


def remove_repeated_lines(rows: DataFrame, min_letters: int = MIN_LETTERS, min_docs: int = MIN_DOCS) -> DataFrame:
    """rows with the repeated lines taken out of text, and n_removed. Other rows come through unchanged with 0."""
    gone = find_repeated_lines(rows, min_letters, min_docs).groupBy("row_nr").agg(F.collect_set("line_nr").alias("__gone"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__gone", i + 1)), "\n")
    out = rows.join(gone, "row_nr", "left")
    return out.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c) for c in rows.columns],
        F.coalesce(F.size("__gone"), F.lit(0)).alias("n_removed"),
    )
