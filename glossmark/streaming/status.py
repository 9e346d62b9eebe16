"""An extension: status logs and events as streams. The reference works in batches; these keep the same tables current."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glossmark.operators.sync import last_by_key


def upsert_stream(log: DataFrame, load: Callable[[], DataFrame | None], store: Callable[[DataFrame, int], None], key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Runs over what is there now: each batch's last rows a key are merged into the stored table. A batch that is run again after a
    failure gives the same table, as the last row of each key wins whatever is already stored."""

    def merge(batch: DataFrame, epoch: int) -> None:
        old = load()
        rows = batch if old is None else old.unionByName(batch)
        store(last_by_key(rows, [key], [order]), epoch)

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(spark: SparkSession, path: str, schema: str, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Counts by type in windows of event time; windows are final once the watermark has passed them."""
    events = spark.readStream.schema(schema).parquet(path)
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return stamped.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
