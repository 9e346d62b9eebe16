"""Exact deduplication by two passes over a Bloom filter, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.llm.common import bloom_blocks, bloom_filter, bloom_probe, bloom_slot, fresh, join_groups, repeated_slots, without, written

OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")
#: One slot a row, so that pass one counts one slot a row; a row that is alone shares it with another one with a chance of 1 in 64.
BITS_PER_ROW = 64
#: The filter that pass two probes holds the slots set more than once, few of all, at as many bits and hashes a slot.
BITS_PER_SLOT, HASHES = 16, 2


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text with each run of ASCII white space as one space; null counts as empty."""
    digest = F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    return F.coalesce(digest, F.lit(""))  # never null: without this each join on it would compute it once more, as a filter


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", digest: str = "text_sha256", bits_per_row: int = BITS_PER_ROW, keep: str = "min") -> DataFrame:
    """Mark all but one of the rows whose digest column is equal.

    Pass one counts the rows that set each slot of a Bloom filter with one hash and keeps the slots set more than once: a slot's
    number is shuffled for each digest of a task, nothing else of the rows. These slots make a filter of their own, sized by their
    number and so far smaller than one of all rows. Pass two probes it with every row: a row whose slot it doesn't hold is alone
    and passes straight through; only the others are shuffled, where an exact group-by on the digest settles them, with sums in
    each task first; groups that hold a large share of the rows are joined by broadcast. False positives cost a shuffle of their
    row, never a wrong result.

    Adds keep_id (smallest, or with keep="max" largest, non-null id of the group; null if all are null), group_size and kept. Rows that repeat an id and a
    digest are copies like any other: exactly one of them is kept. Input columns named like the added ones are replaced. An
    empty table gives an empty table.
    """
    docs = docs.select(*without(docs, {"keep_id", "group_size", "kept"}))
    total = docs.count()
    slots = max(1, total * bits_per_row)
    slot, flag, row = fresh(docs, "slot__"), fresh(docs, "may_repeat"), fresh(docs, "row__")
    repeated = written(repeated_slots(docs.select(digest), digest, slots, slot), "repeated-slots")
    blocks = bloom_blocks(repeated.count(), BITS_PER_SLOT)
    filter_ = written(bloom_filter(repeated, slot, blocks, HASHES), "repeated-filter")
    probed = bloom_probe(docs.withColumn(slot, bloom_slot(F.col(digest), slots)), slot, filter_, blocks, HASHES, flag)
    alone = probed.where(~F.col(flag)).select(*docs.columns, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    flagged = written(probed.where(F.col(flag)).select(*docs.columns, F.monotonically_increasing_id().alias(row)), "may-repeat")
    known = F.col(id_col).isNotNull()
    first = F.min(F.struct((~known).alias("none"), F.col(id_col).alias("id"), row)) if keep == "min" else F.max(F.struct(known.alias("none"), F.col(id_col).alias("id"), row))
    one, kept_row = fresh(docs, "one__"), fresh(docs, "kept_row__")
    groups = flagged.groupBy(digest).agg(first.alias(one), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(digest, F.col(f"{one}.id").alias("keep_id"), F.col(f"{one}.{row}").alias(kept_row), "group_size")
    settled = join_groups(flagged, groups, digest, "group_size", total).withColumn("kept", F.col(row) == F.col(kept_row))
    return alone.unionByName(settled.select(*docs.columns, "keep_id", "group_size", "kept"))


def with_digest(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.select(*without(docs, {"text_sha256"}), text_digest(F.col(text_col)).alias("text_sha256"))
