"""From glyphs to blocks: lines by height, blocks by gaps, and how well a gap cuts. Their classes are in classes.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def text_blocks(glyphs: DataFrame, gap: float = 20.0) -> DataFrame:
    """Blocks (doc, page, block, text, y_top, y_bot, size, bold) of glyphs (doc, page, text, top, bottom, x0, size, fontname).

    Glyphs at one whole-numbered middle height form a line; a line more than `gap` below the last begins a block.
    """
    y = F.floor((F.col("top") + F.col("bottom")) / 2)
    lines = glyphs.withColumn("y", y).groupBy("doc", "page", "y").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x0", "text"))), lambda c: c["text"]), "").alias("line"),
        F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.sum(F.when(F.col("size") > 0, F.col("size"))).alias("sizes"), F.count_if(F.col("size") > 0).alias("sized"),
        F.count_if(F.lower("fontname").contains("bold")).alias("bolds"), F.count("*").alias("n"),
    )
    w = Window.partitionBy("doc", "page").orderBy("y")
    island = lines.withColumn("block", F.sum((F.coalesce(F.col("y") - F.lag("y").over(w), F.lit(0)) > gap).cast("int")).over(w))
    return island.groupBy("doc", "page", "block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y", "line"))), lambda c: c["line"]), " ").alias("text"),
        F.min("top").alias("y_top"), F.max("bottom").alias("y_bot"), (F.sum("sizes") / F.greatest(F.sum("sized"), F.lit(1))).alias("size"), (F.sum("bolds") / F.sum("n")).alias("bold"),
    )


def without_repeats(blocks: DataFrame, within: float = 5.0) -> DataFrame:
    """Blocks that don't repeat the last block that was kept on their page, at nearly the same height.

    What is kept depends on what was kept before, so a page's heights are folded; only the runs of one text need it, and a
    run's heights are a few numbers. Texts stay where they are.
    """
    w = Window.partitionBy("doc", "page").orderBy("y_top", "block")
    run = F.sum(F.when(F.lag("text").over(w).eqNullSafe(F.col("text")) & F.col("text").isNotNull(), 0).otherwise(1)).over(w)
    marked = blocks.withColumn("__run", run)
    far = lambda acc, y: (F.size(acc) == 0) | (F.abs(F.element_at(acc, -1) - y) >= within)
    heights = F.array_sort(F.collect_list(F.struct("y_top", "block")))
    kept = F.aggregate(heights, F.struct(F.array().cast("array<double>").alias("y"), F.array().cast("array<bigint>").alias("b")), lambda acc, x: F.when(
        far(acc["y"], x["y_top"]), F.struct(F.array_append(acc["y"], x["y_top"].cast("double")).alias("y"), F.array_append(acc["b"], x["block"].cast("bigint")).alias("b"))).otherwise(acc), lambda acc: acc["b"])
    keep = marked.groupBy("doc", "page", "__run").agg(kept.alias("__kept"))
    same = ["doc", "page", "__run"]
    return marked.join(keep, same).where(F.array_contains("__kept", F.col("block").cast("bigint"))).drop("__run", "__kept").select(*blocks.columns)


def outside_boxes(glyphs: DataFrame, tables: DataFrame) -> DataFrame:
    """Glyphs whose middle lies in no table box of their page. Boxes are few a page and kept as an array beside it."""
    boxes = tables.groupBy("doc", "page").agg(F.collect_list("bbox").alias("boxes"))
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("top") + F.col("bottom")) / 2
    inside = F.exists("boxes", lambda b: x.between(b["x0"], b["x1"]) & y.between(b["top"], b["bottom"]))
    return glyphs.join(boxes, ["doc", "page"], "left").where(~F.coalesce(inside, F.lit(False))).drop("boxes")


def gap_quality(glyphs: DataFrame, gaps: list[int]) -> DataFrame:
    """(doc, gap, n, median, short_share): how each gap threshold would cut. The thresholds are a short given list."""
    out = None
    for g in gaps:
        b = text_blocks(glyphs, g).select("doc", F.lit(g).alias("gap"), F.length("text").alias("n"))
        out = b if out is None else out.unionByName(b)
    return out.groupBy("doc", "gap").agg(F.count("*").alias("n"), F.median("n").alias("median"), (F.count_if(F.col("n") < 100) / F.count("*")).alias("short_share"), (F.count_if(F.col("n") < 50) / F.count("*")).alias("tiny_share"))


def judged(quality: DataFrame, baseline: DataFrame, least: int = 5, ratio: float = 0.3, most_median: float = 1200.0, enough: float = 150.0, most_short: float = 0.4) -> DataFrame:
    """quality with collapsed and ok. A cut is collapsed with fewer than `least` blocks, less than `ratio` of the baseline's
    (doc, baseline_n), or a median above `most_median`; it's ok if it isn't and its median and share of short blocks suffice."""
    r = quality.join(baseline, "doc", "left")
    base = F.coalesce("baseline_n", F.lit(0))
    collapsed = (F.col("n") < least) | ((base > 0) & (F.col("n") < base * ratio)) | (F.col("median") > most_median)
    return r.withColumn("collapsed", collapsed).withColumn("ok", ~collapsed & (F.col("median") >= enough) & (F.col("short_share") <= most_short))


def tally(judgements: DataFrame) -> DataFrame:
    """(verdict, n): ok, bad and collapsed cuts."""
    verdict = F.when(F.col("collapsed"), "collapsed").when(F.col("ok"), "ok").otherwise("bad")
    return judgements.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def best_gap(quality: DataFrame, enough: float = 150.0) -> DataFrame:
    """(doc, gap): the smallest threshold with a sufficient median, else that of the largest median."""
    w = Window.partitionBy("doc").orderBy(F.when(F.col("median") >= enough, 0).otherwise(1), F.when(F.col("median") >= enough, F.col("gap")).otherwise(-F.col("median")), "gap")
    return quality.withColumn("r", F.row_number().over(w)).where("r = 1").select("doc", "gap")
