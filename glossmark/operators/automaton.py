"""Dictionaries of any size over texts: one automaton for all aliases, so a text's time is that of reading it once."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

#: Bytes of aliases and symbols of one automaton. A larger table is dealt into several, and texts are read once for each.
MAX_TABLE_BYTES = 32 << 20
_ASCII_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


@lru_cache(maxsize=1 << 16)
def _folded(c: str) -> str:
    upper = c.upper()
    lower = (upper if len(upper) == 1 else c).lower()
    return lower if len(lower) == 1 else c


def fold(text: str) -> str:
    """The text with each character's case folded by itself, so places stay what they are."""
    return text.lower() if text.isascii() else "".join(map(_folded, text))


class Matcher:
    """Finds all (symbol, alias) pairs whose alias a text has, in any case; an ASCII alias stands alone, not within a longer ASCII word."""

    def __init__(self, pairs: list[tuple[str, str]]):
        by_alias: dict[str, list[int]] = {}
        self.pairs = pairs
        for i, (_, alias) in enumerate(pairs):
            if alias:
                by_alias.setdefault(fold(alias), []).append(i)
        self.automaton = ahocorasick.Automaton()
        for alias, numbers in by_alias.items():
            bound, free = [i for i in numbers if pairs[i][1].isascii()], [i for i in numbers if not pairs[i][1].isascii()]
            self.automaton.add_word(alias, (len(alias), bound, free))
        if by_alias:
            self.automaton.make_automaton()
        self.empty = not by_alias

    def __call__(self, text: str | None) -> list[int]:
        if not text or self.empty:
            return []
        found: set[int] = set()
        last = len(text) - 1
        for end, (size, bound, free) in self.automaton.iter(fold(text)):
            found.update(free)
            if bound and (end == last or text[end + 1] not in _ASCII_WORD) and (end + 1 == size or text[end - size] not in _ASCII_WORD):
                found.update(bound)
        return sorted(found)


#: The matcher of this Python worker, by its table's name: built once a worker, not once a task.
_built: dict[str, Matcher] = {}


def table_hits(docs: DataFrame, aliases: DataFrame, text: str = "text", max_bytes: int | None = None) -> DataFrame:
    """docs' other columns with symbol and alias, for each row of aliases (symbol, alias) whose alias the text has, once each.

    The table is dealt by a hash into parts of at most about max_bytes, mostly one; a part is collected, sent to the workers once, and all texts are
    read once for it, whatever the number of its aliases. Null and empty aliases match nothing, null texts have none."""
    limit = max_bytes or MAX_TABLE_BYTES
    pairs = aliases.select(F.col("symbol").cast("string").alias("symbol"), F.col("alias").cast("string").alias("alias")).where("alias <> '' and symbol is not null").distinct()
    size = F.octet_length("alias") + F.octet_length("symbol")
    total = pairs.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / limit))
    found = [_part_hits(docs, pairs.where(F.pmod(F.xxhash64("symbol", "alias"), F.lit(parts)) == i), text) for i in range(parts)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _part_hits(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    keep = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast([(r["symbol"], r["alias"]) for r in pairs.sort("symbol", "alias").collect()])
    name = uuid.uuid4().hex
    added = StructType([StructField("symbol", StringType()), StructField("alias", StringType())])
    schema = StructType([*docs.select(*keep).schema.fields, *added.fields])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _built.get(name)
        if matcher is None:
            _built.clear()
            matcher = _built[name] = Matcher(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, hits = [], []
                for i, t in enumerate(part.column(text).to_pylist()):
                    own = matcher(t)
                    rows += [i] * len(own)
                    hits += own
                kept = part.select(keep).take(pa.array(rows, pa.int32()))
                said = [pa.array([matcher.pairs[h][j] for h in hits], pa.string()) for j in (0, 1)]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(kept.columns, arrow, strict=False)), *said], schema=arrow)

    return docs.select(*keep, text).mapInArrow(scan, schema)
