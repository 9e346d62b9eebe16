"""Encoding and decoding of whole texts with a byte-pair vocabulary, by tree concatenation where texts are long."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmark.llm import bpe, long_texts
from glossmark.llm.common import slices


def encode_and_decode(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", part_chars: int = long_texts.PART_CHARS) -> DataFrame:
    """(id_col, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit integers, decoded as the library decodes them.

    A text of more than a leaf (2048 characters) is halved down to leaves, and neighbours are joined, two by two, by re-encoding windows
    around each join that grow until both sides agree (bpe.TreeJoin). One of more than part_chars is cut into parts, which
    Spark deals out; each is such a tree, and their roots are joined the same way. Null texts count as empty: no ids and an empty decoded text. Rows that repeat an id give as many
    rows; an empty table gives none. Other columns of docs, whatever their names, are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    columns = "n_tokens long, ids binary, decoded string"

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.encoder(file)
        for some in slices(batches):
            ids = [coder.encode(t) for t in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())], names=["id", "n_tokens", "ids", "decoded"])

    def part(text: str) -> tuple:
        head, body, tail = bpe.encoder(file).tree.tree(text)
        return long_texts.packed(head), body, long_texts.packed(tail)

    def put(parts: list[dict]) -> tuple:
        coder = bpe.encoder(file)
        pieces = [bpe.Piece(long_texts.unpacked(p["head"]), p["body"], long_texts.unpacked(p["tail"])) for p in parts]
        ids = coder.tree.ids(coder.tree.met(pieces))
        return len(ids) // 4, ids, coder.decode(ids)

    id_type = docs.schema["id"].dataType.simpleString()
    short = docs.where(F.length("text") <= part_chars).mapInArrow(here, f"id {id_type}, {columns}")
    parts = long_texts.parts_of(docs.where(F.length("text") > part_chars), part_chars, 0)
    long = long_texts.assembled(long_texts.encoded(parts, part, "body binary"), put, columns)
    return short.unionByName(long).withColumnRenamed("id", id_col)
