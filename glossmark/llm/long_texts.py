"""Texts too long for one task's comfort, cut into parts that Spark deals out, encodes in parallel and puts together by document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from glossmark.llm import bpe
from glossmark.llm.common import slices

#: Texts of more characters are dealt out in parts of as many. The method is the same on both sides of it: a part, and a text that
#: is none, is encoded in pieces of bpe.TreeJoin.LEAF_CHARS.
PART_CHARS = 65536

_RUN = "struct<text: string, ids: binary, starts: binary, ends: binary>"


def parts_of(docs: DataFrame, part_chars: int, overlap: int) -> DataFrame:
    """(id, text_hash, part, text, n_bytes) of docs (id, text): the text's parts, each but the last going overlap characters on into
    the next; n_bytes is the whole text's. One pass over the text cuts all: a part is matched, and looks ahead at what it shares with the next.
    An empty text has no part."""
    cut = F.regexp_extract_all("text", F.lit(rf"(?s)(?=(.{{1,{part_chars + overlap}}}+)).{{1,{part_chars}}}+"), F.lit(1))
    return docs.select("id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").cast("long").alias("n_bytes"), F.posexplode(cut).alias("part", "text"))


def packed(run: bpe.Run | None) -> dict | None:
    return run and {"text": run.text} | {k: v if v is None else v.tobytes() for k, v in run._asdict().items() if k != "text"}


def unpacked(run: dict | None) -> bpe.Run | None:
    return run and bpe.Run(run["text"], *(v if v is None else np.frombuffer(v, np.uint32) for v in (run["ids"], run["starts"], run["ends"])))


def encoded(parts: DataFrame, encode: Callable[[str], tuple], columns: str) -> DataFrame:
    """Each part with what encode makes of its text: head and tail as runs, and other columns between. Parts are dealt out evenly."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = parts.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, text_hash long, part int, n_bytes long, head {_RUN}, {columns}, tail {_RUN}"
    kinds = to_arrow_schema(_parse_datatype_string(schema))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            found = [encode(t) for t in batch.column("text").to_pylist()]
            kept = [batch.column(c) for c in ("id", "text_hash", "part", "n_bytes")]
            made = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), list(kinds)[4:], strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=kinds.names)

    return parts.repartition(n, "id", "text_hash", "part").mapInArrow(each, schema)


def assembled(parts: DataFrame, put: Callable[[list[dict]], tuple], columns: str) -> DataFrame:
    """A row for each document from its encoded parts. put: from the parts, in order, the row without the id.

    A group is what its own row of the result holds, and the texts of a few words. Rows that repeat an id and a text come as one group;
    each of them gets its row."""
    schema = f"id {parts.schema['id'].dataType.simpleString()}, {columns}"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def rows(table: pa.Table) -> pa.Table:
        found = sorted(table.drop_columns(["id", "text_hash"]).to_pylist(), key=lambda r: r["part"])
        copies = sum(r["part"] == 0 for r in found)
        row = (table.column("id")[0].as_py(), *put(found[::copies]))
        return pa.Table.from_arrays([pa.array([v] * copies, f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

    return parts.groupBy("id", "text_hash").applyInArrow(rows, schema)
