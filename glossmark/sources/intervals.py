"""A cache of daily series by span: of each key, only the days that are wanted and weren't fetched before are fetched."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPAN_SCHEMA = "{key} string, since date, until date"


def merged(spans: DataFrame, key: str) -> DataFrame:
    """(key, since, until) as few spans as cover the same days: those that overlap or touch become one. Both ends belong to a span; spans
    that end before they begin cover nothing."""
    rows = spans.where("until >= since").select(key, "since", "until").distinct()
    order = W.partitionBy(key).orderBy("since", "until")
    reach = F.max("until").over(order.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("since") > F.date_add(reach, 1)), 1).otherwise(0)
    numbered = rows.withColumn("new__", begins).withColumn("run__", F.sum("new__").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return numbered.groupBy(key, "run__").agg(F.min("since").alias("since"), F.max("until").alias("until")).drop("run__")


def gaps(wanted: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """(key, since, until): the days of wanted spans that no kept span has.

    The ends of both are laid out in order; wanted and kept ones are counted as they open and close, and what lies between two ends is a gap
    where a wanted one is open and no kept one. Nothing is laid out by day, so a span costs two rows, whatever its length."""
    ends = []
    for spans, column in ((merged(wanted, key), "wants"), (merged(kept, key), "has")):
        other = "has" if column == "wants" else "wants"
        one = lambda at, n, c=column, o=other: F.struct(at.alias("at"), F.lit(n).alias(c), F.lit(0).alias(o))
        opened, closed = one(F.col("since"), 1), one(F.date_add("until", 1), -1)
        flat = spans.select(key, F.explode(F.array(opened, closed)).alias("e")).select(key, "e.at", "e.wants", "e.has")
        ends.append(flat)
    at = ends[0].unionByName(ends[1]).groupBy(key, "at").agg(F.sum("wants").alias("wants"), F.sum("has").alias("has"))
    order = W.partitionBy(key).orderBy("at")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    open_ = at.select(key, "at", F.sum("wants").over(so_far).alias("wants"), F.sum("has").over(so_far).alias("has"), F.lead("at").over(order).alias("next__"))
    parts = open_.where("wants > 0 and has = 0 and next__ is not null").select(key, F.col("at").alias("since"), F.date_sub("next__", 1).alias("until"))
    return merged(parts, key)


class SeriesCache:
    """Daily rows by key in a folder that the cluster shares. Rows and the spans fetched are two tables; a fetch writes its rows first and names them
    in the spans last, so a run that dies between the two fetches again and leaves rows that nothing reads."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "symbol", day: str = "d"):
        """schema: of the rows, with key and day."""
        self.spark, self.path, self.schema, self.key, self.day = spark, path.rstrip("/"), schema, key, day

    def _read(self, name: str, schema: str) -> DataFrame:
        """The table, empty where nothing was written yet. Whatever else is wrong with it is an error."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def spans(self) -> DataFrame:
        """(key, since, until, run): what was fetched, and by which run."""
        return self._read("spans", SPAN_SCHEMA.format(key=self.key) + ", run string")

    def rows(self) -> DataFrame:
        """All rows of runs that were named, one a key and day: where two runs at once fetched a day, that of the run with the smaller name."""
        named = self.spans().select("run").distinct()
        found = self._read("rows", self.schema + ", run string").join(F.broadcast(named) if named.count() < 10_000 else named, "run", "left_semi")
        columns = [c for c in found.columns if c != "run"]
        return found.groupBy(self.key, self.day).agg(F.min_by(F.struct(*columns), "run").alias("r__")).select("r__.*")

    def through(self, wanted: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows of the wanted spans (key, since, until); fetch makes the rows of the spans that are missing, and isn't called if none is.

        A day without a row, like a holiday, counts as fetched with its span."""
        missing = gaps(wanted, self.spans(), self.key)
        run = uuid.uuid4().hex
        if not missing.isEmpty():
            new = fetch(missing)
            new.select(*[c for c in self._read("rows", self.schema).columns], F.lit(run).alias("run")).write.mode("append").parquet(f"{self.path}/rows")
            missing.select(self.key, "since", "until", F.lit(run).alias("run")).coalesce(1).write.mode("append").parquet(f"{self.path}/spans")
        spans = merged(wanted, self.key)
        days = F.col(self.day).between(F.col("since"), F.col("until"))
        rows = self.rows()
        return rows.join(spans, self.key).where(days).select(*rows.columns)
