"""Token counts of whole texts; huge ones are encoded in overlapping parts that are spliced at stable boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmark.llm import bpe, long_texts
from glossmark.llm.common import slices

OVERLAP_CHARS = bpe.Splices.OVERLAP_CHARS


def token_counts(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", part_chars: int = long_texts.PART_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(id_col, n_bytes, n_tokens) of each row: UTF-8 bytes, and tokens as the library gives them.

    A text of more than 2048 characters is encoded in pieces of as many that overlap, with offsets; neighbours are spliced in their
    overlap at a boundary that provably stands in the whole text too; where the overlap has none, it is widened
    (bpe.Splices). One of more than part_chars is cut into parts that overlap; Spark deals them out, and they are spliced the
    same way. Null texts count as empty. Rows
    that repeat an id give as many rows; an empty table gives none. Other columns, whatever their names, are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    columns = "n_bytes long, n_tokens long"

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = bpe.encoder(file).count
        for batch in slices(batches):
            found = pa.array([count(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), found], names=["id", "n_bytes", "n_tokens"])

    def part(text: str) -> tuple:
        starts, counts, head, tail = bpe.encoder(file).splices.part(text)
        return long_texts.packed(head), starts.tolist(), counts.tolist(), long_texts.packed(tail)

    def put(parts: list[dict]) -> tuple:
        found = [(p["part"] * part_chars, np.array(p["starts"], np.int64), np.array(p["counts"], np.int64), long_texts.unpacked(p["head"]), long_texts.unpacked(p["tail"])) for p in parts]
        return parts[0]["n_bytes"], bpe.encoder(file).splices.counted(found)

    id_type = docs.schema["id"].dataType.simpleString()
    short = docs.where(F.length("text") <= part_chars).withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(here, f"id {id_type}, {columns}")
    parts = long_texts.parts_of(docs.where(F.length("text") > part_chars), part_chars, overlap)
    long = long_texts.assembled(long_texts.encoded(parts, part, "starts array<int>, counts array<int>"), put, columns)
    return short.unionByName(long).withColumnRenamed("id", id_col)
