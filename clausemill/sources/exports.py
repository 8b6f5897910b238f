"""Exports: AsciiDoc, graph drawings, envelopes. Lines are built in the JVM; texts are joined per document, in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.operators.graph import busy_subgraph, degrees


def _joined(df: DataFrame, keys: list[str], order: list[str], line: Column) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct(*order, line.alias("line"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("body"))


def asciidoc(segments: DataFrame) -> DataFrame:
    """(source_file, body): headings by section depth, paragraphs with their role; page furniture is left out."""
    depth = F.least(F.size(F.split("section", r"\.")), F.lit(5))
    line = (
        F.when(F.col("type") == "SECTION", F.concat(F.repeat(F.lit("="), depth + 1), F.lit(" "), F.col("text")))
        .when(F.col("type") == "NORM", F.concat(F.lit("[.normative]\n"), F.col("text")))
        .when(F.col("type") == "INFORM", F.concat(F.lit("[.informative]\n"), F.col("text")))
        .otherwise(F.col("text"))
    )
    kept = segments.where(~F.col("type").isin("HEADER", "FOOTER", "TOC", "OTHER") & F.col("text").isNotNull() & F.col("source_file").isNotNull())
    return _joined(kept, ["source_file"], ["row_nr"], F.concat(line, F.lit("\n")))


# Colours of a drawing's nodes by type of document.
COLOURS = {"EN": "#4CAF50", "TS": "#2196F3", "TR": "#FF9800", "ES": "#9C27B0", "EG": "#795548", "SR": "#607D8B"}


def dot(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(pos, line): the lines of a DOT file of nodes (id, known, kind) and edges; write them sorted by pos.

    Nodes are coloured by kind and known ones have a bold frame; normative edges are solid and dark, others dashed and pale.
    """
    colour = F.lit("#CCCCCC")
    for kind, c in COLOURS.items():
        colour = F.when(F.col("kind") == kind, c).otherwise(colour)
    label = F.replace("id", F.lit(" "), F.lit("\\n"))
    n = nodes.select(F.lit(1).alias("pos"), F.format_string('  "%s" [label="%s", fillcolor="%s", penwidth=%d];', "id", label, colour, F.when(F.col("known"), 2).otherwise(1)).alias("line"))
    normative = F.col("type") == "normative"
    e = edges.select(F.lit(2).alias("pos"), F.format_string('  "%s" -> "%s" [style=%s, color="%s"];', "from_id", "to_id", F.when(normative, "solid").otherwise("dashed"), F.when(normative, "#333333").otherwise("#999999")).alias("line"))
    frame = nodes.sparkSession.createDataFrame([(0, "digraph references { rankdir=LR; node [shape=box, style=filled];"), (3, "}")], "pos int, line string")
    return frame.unionByName(n).unionByName(e.distinct())


def mermaid(edges: DataFrame, kinds: DataFrame, more_than: int = 2, most: int = 100) -> DataFrame:
    """(pos, line): the lines of a Mermaid drawing, in order: edges between nodes with many links, then these nodes' classes.

    Only nodes with more than `more_than` links on one side are drawn, and only the first `most` edges (a drawing's limit).
    kinds (id, kind) gives the class of nodes of the kinds EN, TS and TR.
    """
    name = lambda c: F.translate(c, " -", "__")
    arrow = F.when(F.col("type") == "normative", "-->").otherwise("-.->")
    line = F.format_string('  %s["%s"] %s %s["%s"]', name("from_id"), "from_id", arrow, name("to_id"), "to_id")
    shown = busy_subgraph(edges, more_than)
    drawn = shown.select(F.lit(1).alias("pos"), "from_id", "to_id", line.alias("line")).distinct().orderBy("from_id", "to_id", "line").limit(most).select("pos", "line")
    busy = degrees(edges).where((F.col("in_degree") > more_than) | (F.col("out_degree") > more_than))
    classes = busy.join(kinds.where(F.col("kind").isin("EN", "TS", "TR")), "id").select(F.lit(2).alias("pos"), F.format_string("  class %s %s", name("id"), F.lower("kind")).alias("line"))
    head = edges.sparkSession.createDataFrame([(0, "flowchart LR")], "pos int, line string")
    return head.unionByName(drawn).unionByName(classes.distinct())


def envelopes(segments: DataFrame) -> DataFrame:
    """(source_file, segment_count, type_counts): what heads a segment file."""
    per = segments.where("source_file IS NOT NULL AND type IS NOT NULL").groupBy("source_file", "type").agg(F.count("*").alias("n"))
    return per.groupBy("source_file").agg(F.sum("n").alias("segment_count"), F.sort_array(F.collect_list(F.struct("type", "n"))).alias("t")).select(
        "source_file", "segment_count", F.to_json(F.map_from_entries("t")).alias("type_counts")
    )
