"""What comes from outside: a connector's answers as tables, with retries; the requests are rows, the answers are too.

A connector is a class that a task makes once: `get(url)` returns an Answer or raises OSError. Which hosts are asked, and
how a session is opened, is the connector's own; nothing here opens a connection by itself.

Defined results: a null URL is answered with an error; a request that fails `tries` times comes out with its error; once more
than `most_failures` requests of a task have failed, the rest of its requests come out as 'not asked'.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Answer:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


class Connector(Protocol):
    def get(self, url: str) -> Answer: ...


ANSWER = "url string, status int, body binary, headers map<string,string>, error string"


def fetched(requests: DataFrame, connector: Callable[[], Connector], tries: int = 3, pause: float = 0.5, most_failures: int = 10) -> DataFrame:
    """The answer to each request (url). Pauses grow by `pause` from one try to the next."""

    def ask(c: Connector, url: str | None) -> tuple:
        if not url:
            return url, None, None, None, "no URL"
        error = ""
        for k in range(tries):
            try:
                a = c.get(url)
                return url, a.status, a.body, a.headers, None
            except OSError as e:
                error = str(e) or type(e).__name__
                time.sleep(pause * (k + 1))
        return url, None, None, None, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, failed = connector(), 0
        for b in batches:
            got = []
            for url in b["url"]:
                got.append(ask(c, url) if failed <= most_failures else (url, None, None, None, "not asked"))
                failed += got[-1][4] is not None
            yield pd.DataFrame(got, columns=["url", "status", "body", "headers", "error"])

    return requests.select("url").mapInPandas(run, ANSWER)


def page_requests(spark: SparkSession, template: str, total: int, size: int, first: int = 0) -> DataFrame:
    """(url, offset): the requests of a listing of `total` items in pages of `size`, from offset `first`."""
    rows = spark.range(first, max(first, total), size).withColumnRenamed("id", "offset")
    return rows.select(F.replace(F.lit(template), F.lit("{offset}"), F.col("offset").cast("string")).alias("url"), "offset")


def still_needed(requests: DataFrame, cached: DataFrame, now: str, ttl: int) -> DataFrame:
    """requests (url) without an answer in cached (url, fetched_at) that is younger than ttl seconds."""
    fresh = cached.where(F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("fetched_at") < ttl).select("url").distinct()
    return requests.join(fresh, "url", "left_anti")


def file_name(headers, url, number):
    """A download's name: from its content-disposition, else the end of its URL, else the number; made safe for a path."""
    from clausemill.functions.web import safe_name

    given = F.nullif(F.regexp_extract(F.coalesce(headers["content-disposition"], F.lit("")), r"(?i)filename=\"?([^\";]+)", 1), F.lit(""))
    end = F.nullif(F.regexp_extract(url, r"([^/?#]+\.[A-Za-z0-9]+)(?:[?#].*)?$", 1), F.lit(""))
    return safe_name(F.coalesce(given, end, number))
