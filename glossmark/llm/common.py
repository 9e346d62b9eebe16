"""What several operators of this subpackage share: scratch tables, Bloom filters, column hygiene."""

from __future__ import annotations

import contextlib
import ctypes
import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one Bloom block: what Spark's bitmap_construct_agg holds in one binary value (4 KB).
BLOCK_BITS = 32768
#: A filter is broadcast in parts of up to this size, at most so many, and never gets larger: with more keys it holds more that it was not given.
MAX_BROADCAST_BYTES, MOST_PARTS = 32 << 20, 8


#: Bytes of one Arrow batch on its way to a Python worker, while a scratch table is computed: a worker holds a few batches, whatever the rows' size.
BATCH_BYTES = 4 << 20
_scopes: list[list[str]] = []
#: What a worker keeps from task to task, by name, with what empties it.
_kept: dict[str, Callable[[], None]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it. A folder of this machine only where Spark runs on it alone."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="glossmark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/glossmark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and readable whatever executor is lost later."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """At its end the tables written within it go: write what reads them first, outside of the scope's own list (see kept)."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a table that outlives the scope it is written in."""
    out = written(df, name)
    if _scopes:
        path = _scopes[-1].pop()
        if len(_scopes) > 1:
            _scopes[-2].append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; results that still read them must be written first."""
    _delete(spark, f"{shared_dir(spark).rstrip('/')}/glossmark-{spark.sparkContext.applicationId}")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """df's columns but for those an operator sets itself."""
    drop = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in drop]


def bloom_blocks(rows: int, bits_per_row: int) -> int:
    """Blocks of a filter for so many keys, as many as are broadcast at most. Beyond that a key gets fewer bits: more rows that the filter doesn't hold
    are taken for rows that it may hold, and settled exactly like those; none that it holds is lost, and no row is shuffled to be probed."""
    most = max(1, MAX_BROADCAST_BYTES // (BLOCK_BITS // 8)) * MOST_PARTS
    return max(1, min(most, math.ceil(rows * bits_per_row / BLOCK_BITS)))


def bloom_block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_bits(key: Column, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i + 1)), F.lit(BLOCK_BITS)) for i in range(hashes)]


def bloom_filter(keys: DataFrame, key: str, blocks: int, hashes: int) -> DataFrame:
    """(bloom_block, bloom_map): a blocked Bloom filter of the keys.

    Only (block, bit) pairs are shuffled, each once a task, so that a key with a third of all rows is one row of each task."""
    bits = F.array_distinct(F.array(*bloom_bits(F.col(key), hashes)))
    slots = keys.select(bloom_block(F.col(key), blocks).alias("bloom_block"), F.explode(bits).alias("bit")).distinct()
    return slots.groupBy("bloom_block").agg(F.bitmap_construct_agg("bit").alias("bloom_map"))


def repeated_slots(keys: DataFrame, key: str, slots: int, slot: str) -> DataFrame:
    """(slot): of a Bloom filter with one hash and so many slots, those that two rows or more set; counted in each task before they are shuffled."""
    counted = keys.select(bloom_slot(F.col(key), slots).alias(slot)).groupBy(slot).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n >= 2").select(slot)


def bloom_slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def bloom_probe(df: DataFrame, key: str, filter_: DataFrame, blocks: int, hashes: int, flag: str) -> DataFrame:
    """df with a boolean: whether the filter may hold the key. The filter, of bloom_blocks' size, is broadcast in one part or several; df's rows
    are not shuffled."""
    block, bitmap = fresh(df, "bloom_block"), fresh(df, "bloom_map")
    filter_ = filter_.select(F.col("bloom_block").alias(block), F.col("bloom_map").alias(bitmap))
    a_part = max(1, MAX_BROADCAST_BYTES // (BLOCK_BITS // 8))
    if blocks > a_part * MOST_PARTS:
        raise ValueError(f"a filter of {blocks} blocks is too large; bloom_blocks gives the size")
    joined = df.withColumn(block, bloom_block(F.col(key), blocks))
    names = []
    for first in range(0, blocks, a_part):
        names.append(fresh(df, f"bloom_map_{first}"))
        part = filter_.where(F.col(block).between(first, first + a_part - 1)).withColumnRenamed(bitmap, names[-1])
        joined = joined.join(F.broadcast(part), block, "left")
    joined = joined.withColumn(bitmap, F.coalesce(*names)).drop(*names)
    held = F.col(bitmap).isNotNull()
    for bit in bloom_bits(F.col(key), hashes):
        held &= F.getbit(_byte(bitmap, bit), F.pmod(bit, F.lit(8)).cast("int")) == 1
    return joined.withColumn(flag, F.coalesce(held, F.lit(False))).drop(block, bitmap)


def _byte(bitmap: str, bit: Column) -> Column:
    return F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")


#: A group with at least this share of all rows is hot. There can be no more such groups than its inverse.
HOT_SHARE = 1 / 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows joined with groups, one row a key, on key. Groups with HOT_SHARE of total or more, of which there can be but
    1 / HOT_SHARE, are broadcast, so that no task gets all rows of one; the others are shuffled. Read twice: pass written tables."""
    hot = groups.where(F.col(size) >= max(2.0, total * HOT_SHARE))
    cool = groups.where(F.col(size) < max(2.0, total * HOT_SHARE))
    apart = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return apart.unionByName(rest.join(cool, key))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts are Python objects at a time. At the end the worker gives back what it holds in
    reserve: it stays alive, idle or for other stages, beside those that work."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def keep_only(name: str | None = None, empty: Callable[[], None] | None = None) -> None:
    """Of what this worker keeps from task to task, all but the one named goes, as it belongs to another stage: a worker outlives stages, and what each
    of them keeps would add up."""
    for other in [k for k in _kept if k != name]:
        _kept.pop(other)()
    if name is not None and empty is not None:
        _kept[name] = empty


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has malloc_trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)
