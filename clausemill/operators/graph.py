"""References between documents: extraction, the graph's tables, its statistics, and bounded walks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import materialize

# How each body's documents are cited.
SPEC = r"(?i)(?<![A-Za-z])((?:EN|TS|TR|ES|EG|SR)\s+\d{3}\s*\d{3}(?:-\d+)?)"
RFC, SDJWT = r"(?i)RFC\s*(\d{3,5})", r"(?i)(SD-JWT(?:\s+VC)?)"
ISO, ITU, W3C = r"(?i)ISO(?:/IEC)?\s+(\d+(?:[-–]\d+)*)", r"(?i)ITU-T\s+([A-Z]\.?\s*\d+(?:\.\d+)?)", r"(?i)W3C\s+([\w-]+)"
OPENID = r"(?i)(OpenID4VP|OpenID4VCI|OpenID4VC(?:-HAIP)?|OpenID\s+Connect|OpenID\s+for\s+Verifiable\s+(?:Presentation|Credential)|\bHAIP\b)"
NORMATIVE, INFORMATIVE = r"(?is)normative references(.*?)(?:informative references|\z)", r"(?is)informative references(.*?)(?:\n\s*\d+\s+[A-Z]|\z)"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _space(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def references(text: Column) -> Column:
    """Array of (source, ref): every document cited in a text, normalised, distinct."""
    of = lambda source, found, name: F.transform(found, lambda v: F.struct(F.lit(source).alias("source"), name(v).alias("ref")))
    openid = lambda v: (
        F.when(v.rlike("(?i)VCI|Credential"), "OpenID4VCI").when(v.rlike("(?i)VC-HAIP"), "OpenID4VC-HAIP").when(v.rlike("(?i)VP|Presentation"), "OpenID4VP")
        .when(v.rlike("(?i)4VC"), "OpenID4VC").when(v.rlike("(?i)Connect"), "OpenID Connect").otherwise("HAIP")
    )
    w3c = F.filter(_all(text, W3C), lambda v: ~F.lower(v).isin("technical", "recommendation"))
    return F.array_distinct(F.concat(
        of("spec", _all(text, SPEC), lambda v: F.regexp_replace(_space(F.concat(F.upper(F.left(v, F.lit(2))), F.substr(v, F.lit(3)))), r"(\d{3}) ?(\d{3})", "$1 $2")),
        of("ietf", _all(text, RFC), lambda v: F.concat(F.lit("RFC "), v)),
        of("ietf", _all(text, SDJWT), lambda v: F.when(v.rlike(r"(?i)VC$"), "SD-JWT VC").otherwise("SD-JWT")),
        of("iso", _all(text, ISO), lambda v: F.concat(F.lit("ISO "), F.translate(v, "–", "-"))),
        of("itu", _all(text, ITU), lambda v: F.concat(F.lit("ITU-T "), F.regexp_replace(v, r"[\s.]", ""))),
        of("w3c", w3c, lambda v: F.concat(F.lit("W3C "), v)),
        of("openid", _all(text, OPENID), openid),
    ))


def reference_rows(docs: DataFrame, key: str) -> DataFrame:
    """(key, source, ref), distinct."""
    return docs.select(key, F.explode(references(F.col("text"))).alias("r")).select(key, "r.source", "r.ref").distinct()


def section_references(docs: DataFrame, key: str) -> DataFrame:
    """(key, normative, informative, all): references of a text's reference sections; what is normative isn't informative.

    Without such sections, or with none cited there, `all` holds what the whole text cites and the others are empty.
    """
    refs = lambda c: F.transform(references(c), lambda r: r["ref"])
    n, i = refs(F.regexp_extract("text", NORMATIVE, 1)), refs(F.regexp_extract("text", INFORMATIVE, 1))
    parts = docs.where("text IS NOT NULL").select(key, "text", n.alias("normative"), i.alias("__i")).select(key, "text", "normative", F.array_except("__i", "normative").alias("informative"))
    both = F.array_union("normative", "informative")
    return parts.select(key, "normative", "informative", F.when(F.size(both) > 0, both).otherwise(refs(F.col("text"))).alias("all"))


def visible(nodes: DataFrame, edges: DataFrame, kinds: tuple[str, ...] = ("normative",), stubs: bool = True, roots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The part of a graph that a view shows: edges of some kinds, with or without stubs, or only those at given roots;
    nodes without a shown edge are left out."""
    e = edges.where(F.col("type").isin(*kinds))
    if not stubs:
        known = nodes.where("known").select("id")
        e = e.join(known.withColumnRenamed("id", "to_id"), "to_id", "left_semi").join(known.withColumnRenamed("id", "from_id"), "from_id", "left_semi")
    if roots is not None:
        e = e.join(roots.select(F.col("id").alias("from_id")), "from_id", "left_semi")
    ends = e.select(F.col("from_id").alias("id")).unionAll(e.select("to_id")).distinct()
    return nodes.join(ends, "id", "left_semi"), e.select(*edges.columns)


def clean_edges(edges: DataFrame) -> DataFrame:
    """(edge_id, from_id, to_id, type, source) with ends trimmed and lower-cased; edges without an end or to itself go."""
    end = lambda c: F.lower(F.trim(F.col(c))).alias(c)
    return edges.select("edge_id", end("from_id"), end("to_id"), "type", "source").where("from_id IS NOT NULL AND to_id IS NOT NULL AND from_id <> to_id")


def graph_nodes(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, known): every document, and every end of an edge that is none (a stub)."""
    have = docs.where("source_file IS NOT NULL").select(F.lower(F.trim("source_file")).alias("id")).distinct()
    ends = edges.select(F.col("from_id").alias("id")).unionAll(edges.select("to_id")).distinct()
    return have.withColumn("known", F.lit(True)).unionByName(ends.join(have, "id", "left_anti").withColumn("known", F.lit(False)))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree). Both ends in one pass: a hot node is summed in every task before the shuffle."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("from_id").alias("id"), F.lit(0).alias("i")), F.struct(F.col("to_id").alias("id"), F.lit(1).alias("i")))).alias("e"))
    return ends.groupBy("e.id").agg(F.sum("e.i").alias("in_degree"), F.sum(1 - F.col("e.i")).alias("out_degree"))


def busy_subgraph(edges: DataFrame, more_than: int = 2) -> DataFrame:
    """The edges whose both ends have an in- or out-degree above more_than."""
    busy = degrees(edges).where((F.col("in_degree") > more_than) | (F.col("out_degree") > more_than)).select("id")
    return edges.join(busy.withColumnRenamed("id", "from_id"), "from_id", "left_semi").join(busy.withColumnRenamed("id", "to_id"), "to_id", "left_semi")


#: Edges to a folder, and the most folders, of edges that are walked.
FOLDER_EDGES, MOST_FOLDERS = 500_000, 4096


def reachable(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """(id, depth): all nodes within depth steps of roots (id), at their least depth.

    Distinct edges are written once, in folders by a hash of where they begin; a round reads only its frontier's folders.
    """
    seen = materialize(roots.select("id").distinct().withColumn("depth", F.lit(0)), "reach-0")
    frontier = seen
    links = edges.select("from_id", "to_id").distinct()
    folders = min(MOST_FOLDERS, max(8, edges.count() // FOLDER_EDGES))
    of = lambda c: F.pmod(F.xxhash64(c), F.lit(folders)).cast("int")
    links = materialize(links.withColumn("folder", of("from_id")), "reach-links", by="folder")
    for d in range(1, depth + 1):
        where = [r[0] for r in frontier.select(of("id")).distinct().collect()]
        step = links.where(F.col("folder").isin(where)).join(frontier.select(F.col("id").alias("from_id")), "from_id", "left_semi").select(F.col("to_id").alias("id")).distinct()
        frontier = materialize(step.join(seen, "id", "left_anti").withColumn("depth", F.lit(d)), f"reach-{d}")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def built_edges(docs: DataFrame, key: str, relevant: DataFrame | None = None) -> DataFrame:
    """(from_id, to_id, source, type): edges from each document (key, text) to what its reference sections cite.

    Documents do not cite themselves. `relevant` (ref), if given, is the list of what may be cited: a part of a listed
    standard counts as listed.
    """
    typed = docs.where("text IS NOT NULL").select(key, F.inline(F.array(
        F.struct(F.lit("normative").alias("type"), references(F.regexp_extract("text", NORMATIVE, 1)).alias("r")),
        F.struct(F.lit("informative").alias("type"), references(F.regexp_extract("text", INFORMATIVE, 1)).alias("r")),
    )))
    e = typed.select(F.col(key).cast("string").alias("from_id"), "type", F.inline("r")).select("from_id", F.col("ref").alias("to_id"), "source", "type").where("from_id <> to_id").distinct()
    both = e.where("type = 'normative'").select("from_id", "to_id")
    e = e.where("type = 'normative'").unionByName(e.where("type = 'informative'").join(both, ["from_id", "to_id"], "left_anti").select(e.columns))
    if relevant is None:
        return e
    base = lambda c: F.regexp_replace(c, r"-\d+$", "")
    listed = relevant.select(base(F.col("ref")).alias("__base")).distinct()
    return e.withColumn("__base", base(F.col("to_id"))).join(listed, "__base", "left_semi").select(e.columns)


def reference_counts(sections: DataFrame, key: str) -> DataFrame:
    """(key, normative, informative, total) of section_references."""
    return sections.select(key, F.size("normative").alias("normative"), F.size("informative").alias("informative"), F.size("all").alias("total"))


def titled_nodes(nodes: DataFrame, titles: DataFrame) -> DataFrame:
    """nodes (id, ...) with title from titles (id, title), the first in order of each id; null where there is none."""
    return nodes.join(titles.where("title <> ''").groupBy("id").agg(F.min("title").alias("title")), "id", "left")


def nodes_by_source(nodes: DataFrame) -> DataFrame:
    """(source, n, ids): nodes (id, source) by source, in order. Ids of one source are listed in one row, as a legend needs."""
    return nodes.groupBy("source").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("id")).alias("ids"))
