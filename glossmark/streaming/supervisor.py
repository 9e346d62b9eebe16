"""A queue's runs watched as a stream: each run's log lines make a state, and a run that gives no sign of life ends by a timer.

Log rows are (key, at, status, error), with status one of running, done, error, pending. A row with running begins an attempt, or tells that it goes on;
what comes later by its time counts, and a row that is older than what its key has shown doesn't. A run that stays silent for so many seconds of the log's time is an error, until it speaks again."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import Row

#: Times as microseconds: workers and the state store see the same number whatever their zone.
STATE = "status string, error string, attempts int, at bigint"
OUTPUT = "key string, status string, error string, attempts int, at bigint"
SILENT = "no sign of life"


class Run(StatefulProcessor):
    """One key's state, and a timer while it runs."""

    def __init__(self, silent_seconds: int):
        self.silent_ms = silent_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.state.get() if self.state.exists() else None
        status, error, attempts, at = tuple(held) if held else (None, None, 0, None)
        before = (status, error, attempts, at)
        for row in sorted(rows, key=lambda r: (r.us, r.status)):
            if at is not None and row.us < at:
                continue
            if status == "running" and row.us - at >= self.silent_ms * 1000:
                status = "error"  # the silence before this row, whether or not a timer has told it
            attempts += row.status == "running" and status != "running"
            status, at = row.status, row.us
            error = (row.error or "") if status == "error" else None
        if (status, error, attempts, at) == before:
            return
        self._settle(status, error, attempts, at)
        yield Row(key=key[0], status=status, error=error, attempts=attempts, at=at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if not self.state.exists():
            return
        status, _, attempts, at = tuple(self.state.get())
        if status != "running" or at // 1000 + self.silent_ms > expiredTimerInfo.getExpiryTimeInMs():
            return
        error = f"{SILENT} for {self.silent_ms // 1000} s"
        self._settle("error", error, attempts, at)
        yield Row(key=key[0], status="error", error=error, attempts=attempts, at=at)

    def _settle(self, status, error, attempts, at) -> None:
        self.state.update((status, error, attempts, at))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if status == "running":
            self.handle.registerTimer(at // 1000 + self.silent_ms)

    def close(self) -> None:
        pass


def watched(log: DataFrame, silent_seconds: int, late: str = "0 seconds") -> DataFrame:
    """(key, status, error, attempts, at) of a streaming log, a row whenever a run's state changes. Rows later than late may be left out."""
    rows = log.select("key", "at", F.unix_micros("at").alias("us"), "status", "error").withWatermark("at", late)
    changes = rows.groupBy("key").transformWithState(Run(silent_seconds), OUTPUT, "Update", "EventTime")
    return changes.withColumn("at", F.timestamp_micros("at"))


def keep_watch(spark: SparkSession, log: DataFrame, silent_seconds: int, out: str, checkpoint: str) -> StreamingQuery:
    """Over what the log has now: each batch's changes go to a folder of its own below out, which a batch that is run again replaces."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return watched(log, silent_seconds).writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(changes: DataFrame) -> DataFrame:
    """The last state of each key, from the changes kept (with batch). In a batch a key changes once by its rows, and then by its timer."""
    order = F.struct("batch", (F.coalesce("error", F.lit("")).startswith(SILENT)).alias("timer"))
    last = changes.groupBy("key").agg(F.max_by(F.struct("status", "error", "attempts", "at"), order).alias("s__"))
    return last.select("key", "s__.*")


def replayed(log: DataFrame, silent_seconds: int) -> DataFrame:
    """The same states from the whole log at once, with windows: what the stream comes to once it has read all. The log's clock stands at its last row."""
    order = W.partitionBy("key").orderBy("at", "status")
    rows = log.select("key", "at", "status", "error")
    silent = F.unix_micros("at") - F.unix_micros("was_at__") >= silent_seconds * 1_000_000
    rows = rows.withColumns({"was__": F.lag("status").over(order), "was_at__": F.lag("at").over(order)})
    begins = (F.col("status") == "running") & (F.coalesce("was__", F.lit("")) != "running")
    again = (F.col("status") == "running") & (F.col("was__") == "running") & silent
    states = rows.groupBy("key").agg(F.max_by(F.struct("status", "error", "at"), F.struct("at", "status")).alias("l__"), F.count_if(begins | again).cast("int").alias("attempts"))
    now = rows.agg(F.max("at").alias("now__"))
    hung = (F.col("l__.status") == "running") & (F.unix_micros("now__") - F.unix_micros("l__.at") >= silent_seconds * 1_000_000)
    error = F.when(hung, f"{SILENT} for {silent_seconds} s").when(F.col("l__.status") == "error", F.coalesce("l__.error", F.lit("")))
    return states.crossJoin(F.broadcast(now)).select("key", F.when(hung, "error").otherwise(F.col("l__.status")).alias("status"), error.alias("error"), "attempts", F.col("l__.at").alias("at"))
