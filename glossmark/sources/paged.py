"""A paged source for Spark: one partition a page, fetched on the executors by a function that the caller gives.

The network is the caller's affair: fetch(page) returns rows or raises. Failed fetches are retried, then become rows with an
error, or are served from a snapshot where the caller gives one."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[int], Sequence[tuple]]


def paged_source(name: str, schema: str, fetch: Fetch, snapshot: Fetch | None = None, retries: int = 3, wait_seconds: float = 1.0) -> type[DataSource]:
    """A data source class with the option pages; rows are schema's columns, then page and error."""
    full = f"{schema}, page int, error string"
    width = len(full.split(",")) - 2

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.pages = int(options.get("pages", "1"))

        def partitions(self) -> list[InputPartition]:
            return [InputPartition(i) for i in range(1, self.pages + 1)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            page, error = partition.value, ""
            for attempt in range(retries):
                try:
                    yield from [(*r, page, None) for r in fetch(page)]
                    return
                except Exception as e:  # whatever the caller's client raises
                    error = f"{type(e).__name__}: {e}"
                    time.sleep(wait_seconds * 2**attempt if attempt + 1 < retries else 0)
            if snapshot is not None:
                yield from [(*r, page, None) for r in snapshot(page)]
            else:
                yield (*[None] * width, page, error)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return full

        def reader(self, schema: Any) -> Reader:
            return Reader(dict(self.options))

    return Source


def read_pages(spark: SparkSession, source: type[DataSource], pages: int) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).option("pages", str(pages)).load()


def chart_bars(payloads: DataFrame, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """(symbol, d, close) from chart responses in JSON: the adjusted close where there is one, days in UTC, no null or non-finite values."""
    from pyspark.sql import functions as F

    schema = "chart struct<result: array<struct<timestamp: array<long>, indicators: struct<quote: array<struct<close: array<double>>>, adjclose: array<struct<adjclose: array<double>>>>>>>"
    result = F.get(F.from_json(payload, schema)["chart"]["result"], F.lit(0))
    raw, adjusted = F.get(result["indicators"]["quote"], F.lit(0))["close"], F.get(result["indicators"]["adjclose"], F.lit(0))["adjclose"]
    zipped = F.explode(F.arrays_zip(result["timestamp"].alias("t"), F.coalesce(adjusted, raw).alias("c")))
    rows = payloads.select(symbol, zipped.alias("z")).select(symbol, F.to_date(F.timestamp_seconds("z.t")).alias("d"), F.col("z.c").alias("close"))
    return rows.where("close is not null and not isnan(close) and abs(close) < double('Infinity')")

