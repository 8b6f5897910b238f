"""Ordered-sequence operators as windows over one document: carried values, ordinals, ranges, islands."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.identifiers import version_key


def carried(c: Column, doc: str, order: list[str]) -> Column:
    """The last non-empty value so far in the document."""
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(F.when(c != "", c), ignorenulls=True).over(w)


def latest_versions(docs: DataFrame) -> DataFrame:
    """(norm, version, source_file): of each standard its highest version; equal versions by the last file name."""
    rows = docs.select("norm", "version", "source_file", version_key(F.col("version")).alias("v")).where("norm IS NOT NULL AND v IS NOT NULL")
    return rows.groupBy("norm").agg(F.max(F.struct("v", "source_file", "version")).alias("m")).select("norm", "m.version", "m.source_file")


def section_neighbours(entries: DataFrame) -> DataFrame:
    """(id, prev_id, next_id, parent_num, page_to) for entries (doc, num, id, page_from, last_page): order by page, number."""
    w = Window.partitionBy("doc").orderBy("page_from", "num")
    to = F.coalesce(F.lead("page_from").over(w) - 1, F.col("last_page"))
    parent = F.when(F.col("num").contains("."), F.regexp_replace("num", r"\.[^.]*$", ""))
    return entries.select("id", F.lag("id").over(w).alias("prev_id"), F.lead("id").over(w).alias("next_id"), parent.alias("parent_num"), F.greatest("page_from", to).alias("page_to"))


def paragraph_islands(rows: DataFrame) -> DataFrame:
    """(doc, island, first_id, n, text): neighbours of one type joined while the text before doesn't end a sentence.

    rows: (doc, pos, id, type, text). A merged text ends as its last block does, so looking one back is exact.
    """
    w = Window.partitionBy("doc").orderBy("pos")
    before, kind = F.lag("text").over(w), F.lag("type").over(w)
    joins = (kind == F.col("type")) & F.col("type").isin("NORM", "INFORM") & ~F.rtrim(before).rlike(r"[.!?:]$") & ~F.col("text").rlike(r"^\s*(?:[-•*]|\d+[.)]|[a-z]\)|NOTE|EXAMPLE)")
    marked = rows.withColumn("island", F.sum(F.when(joins, 0).otherwise(1)).over(w))
    return marked.groupBy("doc", "island").agg(
        F.min_by("id", "pos").alias("first_id"), F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("text")
    )


def boundary_candidates(rows: DataFrame, short: int = 120) -> DataFrame:
    """(id, next_id): neighbouring normative or informative rows where a short text ends without a closing mark."""
    w = Window.partitionBy("doc").orderBy("pos")
    both = F.col("type").isin("NORM", "INFORM") & F.col("next_type").isin("NORM", "INFORM")
    out = rows.select("id", "type", "text", F.lead("id").over(w).alias("next_id"), F.lead("type").over(w).alias("next_type"))
    return out.where(both & (F.length("text") < short) & ~F.rtrim("text").rlike(r"[.!?:;]$")).select("id", "next_id")


def even_sample(rows: DataFrame, group: str, order: str, n: int, width: int = 10_000) -> DataFrame:
    """n rows of each group at even distances in its order (the operator is a sample).

    order is one whole-numbered column. Rows fall into ranges of `width` of its values; ranges are counted first, so that a
    row's place is its place in its range plus what lies before, and a group that holds most rows is spread over tasks.
    """
    ranged = rows.withColumn("__range", F.floor(F.col(order) / width))
    sizes = ranged.groupBy(group, "__range").agg(F.count("*").alias("__size"))
    w = Window.partitionBy(group).orderBy("__range")
    placed = sizes.withColumn("__before", F.sum("__size").over(w) - F.col("__size")).withColumn("__all", F.sum("__size").over(Window.partitionBy(group))).drop("__size")
    both = ranged.join(placed, [group, "__range"])
    k = F.row_number().over(Window.partitionBy(group, "__range").orderBy(order)) - 1 + F.col("__before")
    step = F.greatest(F.floor(F.col("__all") / n), F.lit(1))
    out = both.withColumn("__k", k).withColumn("__step", step)
    return out.where((F.col("__k") % F.col("__step") == 0) & (F.col("__k") / F.col("__step") < n)).select(*rows.columns)


def contents_mode(pages: DataFrame, threshold: int = 3, most: int = 6) -> DataFrame:
    """(doc, page, toc_mode) for pages (doc, page, n_lines): pages within a run of contents pages of at most `most`.

    A page with `threshold` contents lines lengthens the run; another page ends it, unless the run has reached `most`,
    from where it never counts as contents again.
    """
    w = Window.partitionBy("doc").orderBy("page")
    is_toc = F.col("n_lines") >= threshold
    marked = pages.withColumn("toc", is_toc).withColumn("run", F.sum(F.when(is_toc, 0).otherwise(1)).over(w))
    island = Window.partitionBy("doc", "run").orderBy("page")
    counted = marked.withColumn("k", F.sum(F.when(F.col("toc"), 1).otherwise(0)).over(island))
    stuck = F.coalesce(F.max("k").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) >= most
    return counted.withColumn("stuck", stuck).select("doc", "page", (F.col("toc") & ~F.col("stuck") & (F.col("k") < most)).alias("toc_mode"))


def merged_tables(tables: DataFrame) -> DataFrame:
    """Tables continued on the next page as one: (doc, first_page, pages, rows). tables: (doc, pos, page, top, bottom, rows)."""
    w = Window.partitionBy("doc").orderBy("pos")
    head, lag = F.col("rows")[0], lambda c: F.lag(c).over(w)
    goes_on = (lag("page") == F.col("page") - 1) & (lag("bottom") >= 0.85) & (F.col("top") <= 0.15) & (lag(head) == head)
    marked = tables.withColumn("goes_on", F.coalesce(goes_on, F.lit(False))).withColumn("island", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(w))
    body = F.when(F.col("goes_on"), F.slice("rows", F.lit(2), F.size("rows"))).otherwise(F.col("rows"))
    parts = F.sort_array(F.collect_list(F.struct("pos", body.alias("rows"))))
    return marked.groupBy("doc", "island").agg(F.min("page").alias("first_page"), F.count("*").alias("pages"), F.flatten(F.transform(parts, lambda p: p["rows"])).alias("rows")).drop("island")


def virtual_pages(paragraphs: DataFrame, most: int = 3000) -> DataFrame:
    """(doc, pos, page): a page is full once its characters reach `most`; a null text has none.

    A sum that starts again is a fold: partitions are sorted by document and position and passed through once, and only the
    lengths travel.
    """
    kinds = dict(paragraphs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc, page, held = None, 1, 0
        for b in batches:
            pages = []
            for d, n in zip(b["doc"].tolist(), b["n"].tolist()):
                if d != doc:
                    doc, page, held = d, 1, 0
                pages.append(page)
                held += n
                if held >= most:
                    page, held = page + 1, 0
            yield pd.DataFrame({"doc": b["doc"], "pos": b["pos"], "page": pages})

    rows = paragraphs.where("doc IS NOT NULL").select("doc", "pos", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    return rows.repartition("doc").sortWithinPartitions("doc", "pos").mapInPandas(run, f"doc {kinds['doc']}, pos {kinds['pos']}, page int")


def milestone_state(milestones: DataFrame, upcoming: int = 3) -> DataFrame:
    """(doc, last_done, pending): the last achieved milestone and the next ones; (doc, pos, name, achieved)."""
    done = F.max_by("name", F.when(F.col("achieved").isNotNull(), F.col("pos")))
    open_ = F.sort_array(F.collect_list(F.when(F.col("achieved").isNull(), F.struct("pos", "name"))))
    return milestones.groupBy("doc").agg(done.alias("last_done"), F.transform(F.slice(open_, 1, upcoming), lambda x: x["name"]).alias("pending"))
