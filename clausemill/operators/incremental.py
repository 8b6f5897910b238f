"""What has changed since the last run, and latest-wins upserts. State is a table; skipping is an anti-join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TTL_SECONDS = 8 * 3600


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """files (path, crc) whose content isn't in the manifest under the same path."""
    return files.join(manifest.select("path", "crc"), ["path", "crc"], "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the last by order, new rows before old ones of the same order."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order], F.desc("__new"))
    return both.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank", "__new")


def insert_missing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and the first of each key of new that old hasn't."""
    return old.unionByName(new.dropDuplicates([key]).join(old.select(key), key, "left_anti").select(old.columns))


def freshness(fetched: DataFrame, now: str, ttl: int = TTL_SECONDS) -> DataFrame:
    """fetched with age in seconds (infinite without a time) and whether it may be used without asking again."""
    age = F.coalesce((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("fetched_at")).cast("double"), F.lit(float("inf")))
    return fetched.withColumn("age", age).withColumn("fresh", F.col("age") < ttl)


def change_state(seen: DataFrame, now: DataFrame) -> DataFrame:
    """(url, state): changed, same or unknown, from etags, else lengths; (url, etag, length) before and now."""
    o, n = seen.select("url", F.col("etag").alias("e0"), F.col("length").alias("l0")), now.select("url", F.col("etag").alias("e1"), F.col("length").alias("l1"))
    by = lambda a, b: F.when(F.col(a).isNull() | F.col(b).isNull(), None).otherwise(F.col(a) == F.col(b))
    same = F.coalesce(by("e0", "e1"), by("l0", "l1"))
    return n.join(o, "url", "left").select("url", F.when(same.isNull(), "unknown").when(same, "same").otherwise("changed").alias("state"))


def evolve(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with the missing ones of columns added as nulls; running it again changes nothing."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def changed_since(sources: DataFrame, outputs: DataFrame) -> DataFrame:
    """sources (stem, modified, ...) that have no output (stem, modified), or one older than they are."""
    made = outputs.groupBy("stem").agg(F.max("modified").alias("__made"))
    return sources.join(made, "stem", "left").where(F.col("__made").isNull() | (F.col("__made") < F.col("modified"))).drop("__made")


def results_index(success: DataFrame, redownloaded: DataFrame, skipped: DataFrame) -> DataFrame:
    """(number, path, bucket): the last record of each number, buckets in this order; within one the last path."""
    tag = lambda df, i, name: df.select("number", "path", F.lit(i).alias("at"), F.lit(name).alias("bucket"))
    rows = tag(success, 0, "success").unionByName(tag(redownloaded, 1, "redownloaded")).unionByName(tag(skipped, 2, "skipped"))
    return rows.where("number IS NOT NULL").groupBy("number").agg(F.max_by(F.struct("path", "bucket"), F.struct("at", "path")).alias("m")).select("number", "m.*")


def run_counts(results: DataFrame) -> DataFrame:
    """(bucket, n): what became of a run's items (number, bucket)."""
    return results.groupBy("bucket").agg(F.count("*").alias("n"))


def regressions(results: DataFrame, previous: DataFrame) -> DataFrame:
    """The items that failed in this run and had succeeded before."""
    good = previous.where(F.col("bucket").isin("success", "redownloaded")).select("number").distinct()
    return results.where(F.col("bucket") == "failed").join(good, "number", "left_semi")


def history_entry(results: DataFrame, previous: DataFrame, at: str) -> DataFrame:
    """(at, kind, number, n): a run's counts by bucket, and its failures and regressions by number. Append it to the history."""
    stamp = F.lit(at).cast("timestamp").alias("at")
    counts = run_counts(results).select(stamp, F.concat(F.lit("count:"), "bucket").alias("kind"), F.lit(None).cast("string").alias("number"), "n")
    item = lambda df, kind: df.select(stamp, F.lit(kind).alias("kind"), F.col("number").cast("string").alias("number"), F.lit(1).cast("bigint").alias("n")).distinct()
    return counts.unionByName(item(results.where(F.col("bucket").isin("failed", "noDownload")), "problem")).unionByName(item(regressions(results, previous), "regression"))


def without_sidecar(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    return files.join(sidecars.select("path").distinct(), "path", "left_anti")


def patched_titles(docs: DataFrame, titles: DataFrame) -> DataFrame:
    """docs (norm, shortname, shortname_source, short_title, full_title, own_short_title) completed by title records.

    titles (number, short_title, full_title, own_short_title), one a number, compared without blanks, hyphens and case. A
    suggested short title always replaces the old one; other titles only fill gaps; a short name of unknown origin is 'static'.
    """
    key = lambda c: F.upper(F.regexp_replace(c, r"[\s-]", ""))
    own = {c: F.col(c).alias(f"__{c}") for c in ("short_title", "full_title", "own_short_title")}
    t = titles.where("number IS NOT NULL").select(key("number").alias("__key"), *own.values()).dropDuplicates(["__key"])
    r = docs.withColumn("__key", key("norm")).join(t, "__key", "left")
    some = lambda c: F.nullif(c, F.lit(""))
    source = F.coalesce(some(F.col("shortname_source")), F.when(some(F.col("shortname")).isNotNull(), "static").otherwise(""))
    return r.withColumns({
        "short_title": F.coalesce(some(F.col("__short_title")), F.col("short_title")), "full_title": F.coalesce(some(F.col("full_title")), F.col("__full_title")),
        "own_short_title": F.coalesce(some(F.col("own_short_title")), F.col("__own_short_title")), "shortname_source": source,
    }).select(*docs.columns)


def to_enrich(items: DataFrame, titles: DataFrame, stopped: DataFrame, only: str | None = None, limit: int | None = None) -> DataFrame:
    """items (number, ...) that still need a title: not stopped, without a complete one; or only the one that is asked for.

    A title that merely says 'Title 1' isn't complete. `limit` is the caller's own cut of the work of one run.
    """
    key = lambda c: F.lower(F.regexp_replace(c, r"[\s_-]", ""))
    if only is not None:
        return items.where(key("number") == key(F.lit(only)))
    dummy = F.col("full_title").rlike(r"(?i)^(title\s*\d+\s*)+$")
    done = titles.where(F.coalesce("full_title", F.lit("")).cast("string") != "").where(~dummy).select(key("number").alias("__key")).distinct()
    left = items.withColumn("__key", key("number")).join(done, "__key", "left_anti").join(stopped.select(key("number").alias("__key")).distinct(), "__key", "left_anti").drop("__key")
    return left.orderBy("number").limit(limit) if limit else left


def first_occurrences(rows: DataFrame, key: str, order: str, limit: int | None = None) -> DataFrame:
    """The first row of each key; with `limit`, which is the caller's, the first so many of those."""
    w = Window.partitionBy(key).orderBy(order)
    one = rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return one.orderBy(order).limit(limit) if limit else one


def index_check(expected: DataFrame, rows: DataFrame, manifest: DataFrame, enough: float = 0.95) -> DataFrame:
    """(source_file, in_meta, n_rows, n_text, n_expected, n_embedded, ok): whether each file is wholly in the index.

    expected (source_file, n_expected): its merged texts; rows (source_file, type, has_embedding): the index; manifest
    (source_file): what was indexed. Embeddings are only asked for when the index has any at all.
    """
    text = F.col("type").isin("NORM", "INFORM")
    per = rows.where("source_file IS NOT NULL").groupBy("source_file").agg(F.count("*").alias("n_rows"), F.count_if(text).alias("n_text"), F.count_if(F.col("has_embedding") == 1).alias("n_embedded"))
    any_ = per.agg((F.coalesce(F.sum("n_embedded"), F.lit(0)) > 0).alias("__any"))
    met = manifest.select("source_file").distinct().withColumn("in_meta", F.lit(True))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    r = expected.join(per, "source_file", "left").join(met, "source_file", "left").join(F.broadcast(any_)).select("source_file", F.coalesce("in_meta", F.lit(False)).alias("in_meta"), zero("n_rows"), zero("n_text"), "n_expected", zero("n_embedded"), "__any")
    embedded = ~F.col("__any") | ((F.col("n_text") > 0) & (F.col("n_embedded") >= enough * F.col("n_text")))
    return r.withColumn("ok", F.col("in_meta") & (F.col("n_rows") > 0) & (F.col("n_text") >= F.col("n_expected")) & embedded).drop("__any")


def index_statistics(rows: DataFrame) -> DataFrame:
    """(norm, type, n, embedded) with subtotals by norm and the total, where type, or norm too, is null and level tells which."""
    cube = rows.rollup("norm", "type").agg(F.count("*").alias("n"), F.sum(F.coalesce("has_embedding", F.lit(0))).alias("embedded"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "type").when(F.col("gid") == 1, "norm").otherwise("total")
    return cube.withColumn("level", level).drop("gid")


def to_resegment(stems: DataFrame, rules: DataFrame) -> DataFrame:
    """The documents (stem, ...) for which a rule has been learned."""
    return stems.join(rules.where("stem IS NOT NULL").select("stem").distinct(), "stem", "left_semi")


def all_items(active: DataFrame, published: DataFrame) -> DataFrame:
    """Both lists as one, with the list that each item is of; columns that one of them lacks are null."""
    return active.withColumn("list", F.lit("active")).unionByName(published.withColumn("list", F.lit("published")), allowMissingColumns=True)


def url_records(files: DataFrame, at: str) -> DataFrame:
    """(path, url, source, saved_at): where each file was fetched from, and what kind of place that is."""
    from clausemill.functions.web import url_class

    return files.where("url IS NOT NULL").select("path", "url", url_class(F.col("url")).alias("source"), F.lit(at).cast("timestamp").alias("saved_at"))
