"""References to records that do not exist: direct orphans, and the fixpoint cascade of those that hang on them.

A reference is orphaned directly when its target is absent, deleted, or became available only after the record that
refers to it. A record is orphaned by inheritance when one of its references, or its parent, is itself an orphaned
record. Directly orphaned references are the cascade's round 0; each further round semi-joins the links down the
foreign-key graph with the records found in the round before. Links are written once, in folders by a hash of their
target, and a round reads only the folders in which the last round's records lie.

Defined results: null references and null elements are no references; a null array has none; a record without a key
keeps its references under a null key; a target delivered more than once counts as deleted if any delivery is, and as
available from its earliest delivery; null times never make a reference late; repeated rows are reported once; empty
tables give an empty result; further columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import materialize

#: A section number alone, such as 5, 5.1.2, A or B.3.
BARE_SECTION = r"^([a-z]|[0-9]+)(\.[0-9]+)*$"


def _key(c):
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def target_states(targets: DataFrame, key: str, since: str) -> DataFrame:
    """One row per target key: when it became available and whether it is deleted. Combines map-side."""
    return (
        targets.where(F.col(key).isNotNull())
        .groupBy(_key(F.col(key)).alias("ref"))
        .agg(F.min(since).alias("available_at"), F.max(F.col("deleted_at").isNotNull()).alias("is_deleted"))
    )


def section_references(toc: DataFrame) -> DataFrame:
    """cross_refs of toc_segments as rows (src_key, ref, at), bare section numbers completed by the own source file."""
    own = F.substring_index(_key(F.col("id")), "#", 1)
    r = _key(F.col("raw_ref"))
    return (
        toc.select("id", F.col("extracted_at").alias("at"), F.explode("cross_refs").alias("raw_ref"))
        .where(F.col("raw_ref").isNotNull() & (r != ""))
        .select(
            F.col("id").alias("src_key"),
            F.when(r.rlike(BARE_SECTION), F.concat(F.coalesce(own, F.lit("")), F.lit("#"), r)).otherwise(r).alias("ref"),
            "at",
        )
    )


def edge_references(edges: DataFrame) -> DataFrame:
    r = _key(F.col("to_id"))
    return edges.where(F.col("to_id").isNotNull() & (r != "")).select(
        F.col("edge_id").cast("string").alias("src_key"), r.alias("ref"), F.col("found_at").alias("at")
    )


def _reason(refs: DataFrame, states: DataFrame) -> DataFrame:
    """refs with the reason of their being orphaned, null for sound ones. states has one row a key, so rows don't multiply."""
    return refs.join(states, "ref", "left").select(
        *refs.columns,
        F.when(F.col("is_deleted").isNull(), "absent")
        .when(F.col("is_deleted"), "deleted")
        .when(F.col("available_at") > F.col("at"), "late")
        .alias("reason"),
    )


def direct_orphans(toc: DataFrame, docs: DataFrame, edges: DataFrame) -> DataFrame:
    """Orphaned references (src_table, src_key, ref, at, reason), distinct."""
    of_toc = _reason(section_references(toc), target_states(toc, "id", "extracted_at"))
    of_edges = _reason(edge_references(edges), target_states(docs, "source_file", "ingested_at"))
    return (
        of_toc.withColumn("src_table", F.lit("toc_segments"))
        .unionByName(of_edges.withColumn("src_table", F.lit("ref_edges")))
        .where(F.col("reason").isNotNull())
        .select("src_table", "src_key", "ref", "at", "reason")
        .distinct()
    )


#: Links to a folder, and the most folders; folder numbers are all that a round sends to the driver.
FOLDER_LINKS, MOST_FOLDERS = 200_000, 4096


class Cascade:
    """The fixpoint cascade over the foreign-key graph of toc_segments (cross_refs and parent, both to id) and of ref_edges
    (to_id, to spec_docs, from which nothing hangs): round 0 is `direct`, the rounds after it are run by `records`."""

    def __init__(self, toc: DataFrame, docs: DataFrame, edges: DataFrame):
        self.toc, self.direct = toc, direct_orphans(toc, docs, edges)

    def _links(self) -> tuple[DataFrame, int]:
        """(child, target, at, folder): every reference and parent of a record that has a key."""
        refs = section_references(self.toc).select(F.col("src_key").alias("child"), F.col("ref").alias("target"), "at")
        parents = self.toc.where(F.col("parent").isNotNull()).select(F.col("id").alias("child"), _key(F.col("parent")).alias("target"), F.col("extracted_at").alias("at"))
        links = refs.unionByName(parents).groupBy("child", "target").agg(F.min("at").alias("at"))
        folders = min(MOST_FOLDERS, max(8, self.toc.count() // FOLDER_LINKS))
        return materialize(links.withColumn("folder", F.pmod(F.xxhash64("target"), F.lit(folders)).cast("int")), "orphans-links", by="folder"), folders

    def records(self, max_rounds: int = 1000) -> DataFrame:
        """Orphaned records (src_table, src_key, at, kind, round): kind direct at round 0, inherited after it.

        A record's round is its distance from the nearest direct orphan; the loop ends when a round adds no record.
        """
        self.direct = materialize(self.direct, "orphans-direct")
        found = self.direct.where(F.col("src_key").isNotNull()).groupBy("src_table", "src_key").agg(F.min("at").alias("at"))
        self.links, folders = self._links()
        rounds = [materialize(found.withColumn("round", F.lit(0)), "orphans-round-0")]
        frontier = seen = rounds[0].where(F.col("src_table") == "toc_segments").select("src_key", "at", "round")
        for n in range(1, max_rounds + 1):
            targets = frontier.select(_key(F.col("src_key")).alias("target")).distinct()
            where = [r[0] for r in targets.select(F.pmod(F.xxhash64("target"), F.lit(folders)).cast("int")).distinct().collect()]
            hit = self.links.where(F.col("folder").isin(where) & F.col("child").isNotNull()).join(targets, "target", "left_semi")
            new = hit.groupBy(F.col("child").alias("src_key")).agg(F.min("at").alias("at")).join(seen, "src_key", "left_anti")
            frontier = materialize(new.withColumn("round", F.lit(n)), f"orphans-round-{n}")
            if frontier.isEmpty():
                break
            rounds.append(frontier.withColumn("src_table", F.lit("toc_segments")).select(rounds[0].columns))
            seen = seen.unionByName(frontier)
        else:
            raise RuntimeError(f"the cascade did not end within {max_rounds} rounds")
        out = rounds[0]
        for r in rounds[1:]:
            out = out.unionByName(r)
        return out.select("src_table", "src_key", "at", F.when(F.col("round") == 0, "direct").otherwise("inherited").alias("kind"), "round")


def orphan_cascade(toc: DataFrame, docs: DataFrame, edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    return Cascade(toc, docs, edges).records(max_rounds)


def orphan_report(toc: DataFrame, docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(src_table, period, kind, refs, records): orphan references, and the records that hold them, per table and month.

    A reference is direct, or inherited when its target is an orphaned record and it isn't direct itself. Records without
    a key count as one record a month and kind, their references in full.
    """
    cascade = Cascade(toc, docs, edges)
    orphaned = cascade.records().where(F.col("src_table") == "toc_segments").select(_key(F.col("src_key")).alias("target")).distinct()
    direct = cascade.direct.select("src_table", "src_key", "ref", "at", F.lit("direct").alias("kind"))
    own = cascade.direct.where(F.col("src_table") == "toc_segments").select("src_key", "ref").distinct()
    hung = cascade.links.join(orphaned, "target", "left_semi").select(F.lit("toc_segments").alias("src_table"), F.col("child").alias("src_key"), F.col("target").alias("ref"), "at", F.lit("inherited").alias("kind"))
    inherited = hung.join(own, hung["src_key"].eqNullSafe(own["src_key"]) & (hung["ref"] == own["ref"]), "left_anti")
    rows = direct.unionByName(inherited).withColumn("period", F.date_format("at", "yyyy-MM"))
    per = rows.groupBy("src_table", "period", "kind", "src_key").agg(F.count("*").alias("refs"))
    return per.groupBy("src_table", "period", "kind").agg(F.sum("refs").alias("refs"), F.count("*").alias("records"))
