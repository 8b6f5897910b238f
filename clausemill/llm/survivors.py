"""One surviving record for each group of duplicates, built field by field.

Candidates are ranked by trust, then recency, then the value itself, in one window per (group, field); each task keeps
only its own best before the shuffle (the rank filter becomes a group limit), so a group holding a third of all rows
costs a row a task. Only usable values are ranked at all. For whole records the rank begins with their completeness.

Defined results: a null id groups nothing and is left out; a record's trust is that of its profile, worst if the
profile is null or unknown (or twice listed: the best listed); null times count as oldest; equal trust and time are
decided by the smallest value; a field without a usable value is ''; empty tables give an empty result; repeated rows
are two records of a group; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORST_TRUST = 2147483647
VERSION = r"^v[0-9]+\.[0-9]+\.[0-9]+$"


def _with_trust(records: DataFrame, kinds: DataFrame) -> DataFrame:
    """records with trust. kinds has a handful of rows and is one row a profile after its aggregation."""
    trust = kinds.where(F.col("profile").isNotNull()).groupBy(F.col("profile").alias("__profile")).agg(F.min("trust").alias("__trust"))
    return records.join(trust, records["profile"] == trust["__profile"], "left").withColumn("__trust", F.coalesce("__trust", F.lit(WORST_TRUST)))


def _listed(records: DataFrame, field: str, reference: DataFrame) -> DataFrame:
    """Marks __ok_<field>: the value is in the reference list."""
    known = reference.where(F.col(field).isNotNull()).select(F.col(field).alias("__known")).distinct().withColumn(f"__ok_{field}", F.lit(True))
    return records.join(known, records[field] == known["__known"], "left").drop("__known")


def duplicate_groups(records: DataFrame, least: int = 2) -> DataFrame:
    return records.where(F.col("id").isNotNull()).groupBy("id").agg(F.count("*").alias("n_records")).where(F.col("n_records") >= least)


def usable_values(records: DataFrame, kinds: DataFrame, catalog: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, row_nr, trust, segmented_at, and norm, version, source_file where usable, else null)."""
    r = records.where(F.col("id").isNotNull()).select("row_nr", "id", "norm", "version", "source_file", "profile", "segmented_at")
    r = _listed(_listed(_with_trust(r, kinds), "norm", catalog), "source_file", docs)
    return r.select(
        "id",
        "row_nr",
        F.col("__trust").alias("trust"),
        "segmented_at",
        F.when(F.col("__ok_norm"), F.col("norm")).alias("norm"),
        F.when(F.col("version").rlike(VERSION), F.col("version")).alias("version"),
        F.when(F.col("__ok_source_file"), F.col("source_file")).alias("source_file"),
    )


def best_fields(records: DataFrame, kinds: DataFrame, catalog: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, norm, version, source_file): per field the best usable value of each id held by two or more records."""
    groups = duplicate_groups(records)
    usable = usable_values(records, kinds, catalog, docs).join(groups, "id", "left_semi")
    fields = ("norm", "version", "source_file")
    long = usable.select("id", "trust", "segmented_at", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x"))
    long = long.select("id", "trust", "segmented_at", "x.field", "x.value").where(F.col("value").isNotNull())
    order = Window.partitionBy("id", "field").orderBy(F.col("trust").asc(), F.col("segmented_at").desc_nulls_last(), F.col("value").asc())
    top = long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == 1)
    best = top.groupBy("id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    return groups.join(best, "id", "left").select("id", *[F.coalesce(f, F.lit("")).alias(f) for f in fields])


def surviving_records(records: DataFrame, kinds: DataFrame, catalog: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, row_nr, completeness, n_records): of each id's records the most complete, then trusted, then recent one."""
    usable = usable_values(records, kinds, catalog, docs)
    complete: Column = sum((F.col(f).isNotNull().cast("int") for f in ("norm", "version", "source_file")), F.lit(0))
    order = Window.partitionBy("id").orderBy(F.col("completeness").desc(), F.col("trust").asc(), F.col("segmented_at").desc_nulls_last(), F.col("row_nr").asc())
    top = usable.withColumn("completeness", complete).withColumn("rank", F.row_number().over(order)).where(F.col("rank") == 1)
    return top.join(duplicate_groups(records, 1), "id").select("id", "row_nr", "completeness", "n_records")
