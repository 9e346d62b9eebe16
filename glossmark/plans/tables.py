"""The driver's tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar a symbol and day: the largest order of a priority on a day stands for its close."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("d")).agg(F.max("o_totalprice").alias("close"))


BARS = "SELECT o_orderpriority AS symbol, o_orderdate::DATE AS d, max(o_totalprice) AS close FROM orders GROUP BY ALL"

FIRST_DAY, SPAN = "1995-06-01", 2000


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a stand-in day, as they have none."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % SPAN).cast("int"))
    return table(spark, sf_dir, "documents").withColumn("day", day)


DATED = f"SELECT *, DATE '{FIRST_DAY}' + (doc_id % {SPAN})::INT AS day FROM documents"
