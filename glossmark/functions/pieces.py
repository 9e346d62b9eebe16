"""Python functions of one value as columns. A worker holds one Arrow batch as it came; of it, it has one value and few results as Python objects."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

#: Results are handed on when there are so many, or when so many characters of text have been read for them.
ROWS, CHARS = 512, 1 << 20


def give_back() -> None:
    """What this worker holds in reserve: it stays alive, idle or for other stages, beside those that work."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has malloc_trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def in_pieces(batches: Iterator[pa.Array], each: Callable, kind: pa.DataType) -> Iterator[pa.Array]:
    """each's results for all values in order, some at a time."""
    for batch in batches:
        found, chars = [], 0
        for value in batch:
            text = value.as_py()
            found.append(each(text))
            chars += len(text or "")
            if len(found) >= ROWS or chars >= CHARS:
                yield pa.array(found, kind)
                found, chars = [], 0
        if found:
            yield pa.array(found, kind)
    give_back()


def by_value(each: Callable, returns: DataType = StringType(), kind: pa.DataType = pa.string()):
    """each, a function of one text or null, as a function of a column; returns and kind are its result's type in Spark and in Arrow."""

    @F.arrow_udf(returns)
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_pieces(batches, each, kind)

    return column
