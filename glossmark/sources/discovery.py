"""Pages whose number the source finds out: a batch reads as many as the first one says there are, a stream goes on to the first empty one.

The network is the caller's affair: fetch(page) returns (rows, total), where total is the number of pages if the page tells it, else None; or
it raises, and is tried again."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from glossmark.operators.sync import last_by_key

Fetch = Callable[[int], tuple[Sequence[tuple], int | None]]


class Page(InputPartition):
    """A page to fetch; rows that the driver has fetched already, to learn the total, come along."""

    def __init__(self, page: int, rows: Sequence[tuple] | None = None):
        super().__init__(page)
        self.page, self.rows = page, rows


def patient(fetch: Fetch, page: int, retries: int, wait_seconds: float) -> tuple[Sequence[tuple], int | None]:
    """fetch, tried again after longer and longer waits; the last failure goes on to the caller."""
    for attempt in range(retries):
        try:
            return fetch(page)
        except Exception:  # whatever the caller's client raises
            if attempt + 1 == retries:
                raise
            time.sleep(wait_seconds * 2**attempt)
    raise ValueError("retries must be 1 at least")


def discovered_source(name: str, schema: str, fetch: Fetch, retries: int = 3, wait_seconds: float = 1.0) -> type[DataSource]:
    """A data source class. Rows are schema's columns, then page and error: a page that fails to the end is one row with its error, but for
    the first one, without which nothing is known. Option limit: pages to read at most, of a batch, or of each batch of a stream."""
    full = f"{schema}, page int, error string"
    width = len(full.split(",")) - 2

    def rows_of(partition: Page) -> Iterator[tuple]:
        try:
            rows = partition.rows if partition.rows is not None else patient(fetch, partition.page, retries, wait_seconds)[0]
        except Exception as e:
            yield (*[None] * width, partition.page, f"{type(e).__name__}: {e}")
            return
        yield from ((*r, partition.page, None) for r in rows)

    class Batch(DataSourceReader):
        def __init__(self, limit: int | None):
            self.limit = limit

        def partitions(self) -> list[InputPartition]:
            rows, total = patient(fetch, 1, retries, wait_seconds)
            pages = 1 if total is None else max(1, total)
            return [Page(i, list(rows) if i == 1 else None) for i in range(1, min(pages, self.limit or pages) + 1)]

        def read(self, partition: Page) -> Iterator[tuple]:
            return rows_of(partition)

    class Stream(DataSourceStreamReader):
        """Its offset is the last page that had rows. The driver looks ahead, page by page, for the first empty one and keeps nothing of what it
        sees; the executors fetch the pages between two offsets, so a batch that is run again reads the same pages."""

        def __init__(self, limit: int | None):
            self.limit, self.seen = limit, None

        def initialOffset(self) -> dict:
            return {"page": 0}

        def latestOffset(self) -> dict:
            page = self.seen or 0
            while (self.limit is None or page - (self.seen or 0) < self.limit) and patient(fetch, page + 1, retries, wait_seconds)[0]:
                page += 1
            self.seen = page
            return {"page": page}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            self.seen = max(self.seen or 0, end["page"])
            return [Page(i) for i in range(start["page"] + 1, end["page"] + 1)]

        def read(self, partition: Page) -> Iterator[tuple]:
            return rows_of(partition)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return full

        def _limit(self) -> int | None:
            return int(self.options["limit"]) if "limit" in self.options else None

        def reader(self, schema: Any) -> Batch:
            return Batch(self._limit())

        def streamReader(self, schema: Any) -> Stream:
            return Stream(self._limit())

    return Source


def crawl_list(spark: SparkSession, source: type[DataSource], url: str = "url", limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, failed): the rows of all pages, each url once as its first page has it, and the pages that failed, with their errors."""
    spark.dataSource.register(source)
    read = spark.read.format(source.name())
    rows = (read.option("limit", str(limit)) if limit else read).load()
    order = F.negate("page").alias("back__")
    items = last_by_key(rows.where("error is null").withColumn("back__", order), [url], ["back__"])
    return items.drop("back__", "error"), rows.where("error is not null").select("page", "error")


def crawl(links: DataFrame, seeds: DataFrame, settle: Callable[[DataFrame], DataFrame], depth: int, allowed: Callable[[Column], Column] | None = None) -> DataFrame:
    """(page, depth): what links (page, to) reach from seeds (page) in at most depth steps, each page once, at its least depth.

    A round follows the links of the pages that were new in the round before, and leaves out by an anti-join what was seen; it ends when
    nothing is new. Pages for which allowed doesn't hold are neither kept nor followed, seeds aside. settle makes a table of each round."""
    frontier = settle(seeds.select("page", F.lit(0).alias("depth")).where("page is not null").distinct())
    seen = frontier
    edges = links.where("page is not null and to is not null").select("page", "to").distinct()
    for step in range(1, depth + 1):
        reached = edges.join(frontier.select("page"), "page", "left_semi").select(F.col("to").alias("page")).distinct()
        if allowed is not None:
            reached = reached.where(allowed(F.col("page")))
        frontier = settle(reached.join(seen.select("page"), "page", "left_anti").withColumn("depth", F.lit(step)))
        if frontier.isEmpty():
            break
        seen = settle(seen.unionByName(frontier))
    return seen
