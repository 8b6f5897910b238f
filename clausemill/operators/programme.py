"""Work items of a programme: the current one of each number, counts, orders, and what is due when.

Which stages count as active, and which words make a category, are the caller's: they're patterns given in order.

Defined results: items without a number are left out; dates that are missing sort last; ties are broken by number; an empty
table gives empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import shortened, strip


def current_items(items: DataFrame, key: str = "number", by: str = "work_item_id", pos: str = "pos") -> DataFrame:
    """The item of each number with the largest id; of equal ones the first by position."""
    top = items.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*items.columns), F.struct(F.col(by).cast("bigint"), -F.col(pos))).alias("m"))
    return top.select("m.*")


def is_active(stage: Column, active: Sequence[str]) -> Column:
    """Whether the stage, its line breaks read as blanks, holds one of the words."""
    clean = strip(F.regexp_replace(F.coalesce(stage, F.lit("Unknown")), r"[\n\t]+", " "))
    out = F.lit(False)
    for word in active:
        out = out | clean.contains(word)
    return out


def bucket(text: Column, rules: Sequence[tuple[str, str]], rest: str = "Other") -> Column:
    """The name of the first rule (name, pattern) that the text satisfies."""
    out = F.lit(rest)
    for name, pattern in reversed(list(rules)):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return F.when(text.isNull(), rest).otherwise(out)


def counts(items: DataFrame, kind: str = "kind", stage: str = "stage") -> DataFrame:
    """(dimension, value, n): items by kind and by stage, from one pass."""
    each = F.inline(F.array(F.struct(F.lit("kind").alias("dimension"), F.col(kind).alias("value")), F.struct(F.lit("stage").alias("dimension"), F.col(stage).alias("value"))))
    return items.select(each).groupBy("dimension", "value").agg(F.count("*").alias("n"))


def split_counts(items: DataFrame) -> DataFrame:
    """(kind, active, published, total) of items (kind, active)."""
    return items.groupBy("kind").agg(F.count_if("active").alias("active"), F.count_if(~F.col("active")).alias("published"), F.count("*").alias("total"))


def by_due_date(items: DataFrame) -> DataFrame:
    """Active items by the next date, else the current one, those without any last."""
    return items.where("active").orderBy(F.coalesce("next_date", "status_date").asc_nulls_last(), "number")


def by_publication(items: DataFrame) -> DataFrame:
    """Published items, the latest first, those without a date last."""
    return items.where("NOT active").orderBy(F.desc_nulls_last("status_date"), "number")


def upcoming(items: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    """(month, at, number, next_date): items due within `days`, numbered within their month in the order of their dates."""
    day = F.to_date(F.lit(as_of))
    due = items.where(F.col("active") & F.to_date("next_date").between(day, F.date_add(day, days)))
    month = F.date_format("next_date", "yyyy-MM")
    return due.withColumn("month", month).withColumn("at", F.row_number().over(Window.partitionBy("month").orderBy("next_date", "number"))).select("month", "at", "number", "next_date")


def report_lines(items: DataFrame, as_of: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(part, pos, line): a Markdown report of active items, by category, published ones by kind, and what is due.

    Write it sorted by part and pos. Titles are cut, pipes escaped; every line is built in the task that has its item.
    """
    cell = lambda c: F.replace(F.coalesce(c, F.lit("-")), F.lit("|"), F.lit("\\|"))
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("-"))
    row = lambda *cols: F.concat(F.lit("| "), F.concat_ws(" | ", *cols), F.lit(" |"))
    number, title = cell(F.col("number")), lambda n: cell(shortened(F.col("title"), n))
    due = F.coalesce(day(F.coalesce("next_date", "status_date")), F.lit("9999"))
    active, done = items.where("active"), items.where("NOT active")
    whole = active.select(F.lit("1 active").alias("part"), F.concat_ws(" ", due, "number").alias("pos"), row(number, title(60), cell(F.col("stage")), day("status_date"), day("next_date")).alias("line"))
    grouped = active.withColumn("cat", bucket(F.lower(F.concat_ws(" ", "number", "title")), rules)).select(F.concat(F.lit("2 category "), "cat"), F.concat_ws(" ", due, "number"), row(number, title(50), cell(F.col("stage")), day("next_date")))
    published = done.select(F.concat(F.lit("3 published "), "kind"), F.concat_ws(" ", F.format_string("%012d", F.lit(10**11) - F.coalesce(F.unix_timestamp("status_date"), F.lit(0))), "number"), row(number, title(70), day("status_date")))
    soon = upcoming(items, as_of).join(items.select("number", "title"), "number").select(F.concat(F.lit("4 due "), "month"), F.format_string("%08d", "at"), row(day("next_date"), number, title(40)))
    return whole.union(grouped).union(published).union(soon)
