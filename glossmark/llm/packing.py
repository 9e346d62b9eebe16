"""Best-fit packing of token sequences by exact complements, planned on the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from glossmark.llm import bpe
from glossmark.llm.common import slices, written

CAPACITY = 4096
END_ID = 1


def token_pieces(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, ids): each text's ids and end_id, cut into pieces of capacity where longer.

    Null texts count as empty: one piece that is end_id alone."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = bpe.encoder(file), end_id.to_bytes(4, "little")
        for batch in slices(batches):
            rows = []
            for key, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                ids = coder.encode(text or "") + end
                rows += [(key, i // capacity // 4, i // 4, len(x) // 4, zlib.crc32(x), x) for i in range(0, len(ids), 4 * capacity) for x in (ids[i : i + 4 * capacity],)]
            kinds = [batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(id_col, text_col).mapInArrow(cut, f"{id_col} {id_type}, piece int, start long, length long, ids_crc32 long, ids binary")


class Plan:
    """Which lengths share a sequence, and how many sequences are alike. Its size follows capacity, not the number of pieces.

    pairs is the index of pair sums: by sum, how many pairs of lengths that are left make it up. It is kept in step as lengths run
    out; a triple is a length that is left and a pair whose sum is the rest."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        """Complements of up to three lengths use up short ones that would fill gaps better where all lengths are few. So there is a plan
        with up to three, one with two and one with one; that of fewest sequences stands, of equal ones the first."""
        self.capacity = capacity
        plans = []
        for self.most in (3, 2, 1):
            self.left = np.zeros(capacity + 1, np.int64)
            self.left[list(histogram)] = list(histogram.values())
            there = np.flatnonzero(self.left)
            self.pairs = np.zeros(2 * capacity + 1, np.int64)
            for i, a in enumerate(there):
                self.pairs[a + there[i:]] += 1
            self.patterns: list[tuple[int, list[int]]] = []
            for length in range(capacity, 0, -1):
                while self.left[length] and (more := self._complement(length)) is not None:
                    self._take([length, *more])
            self._best_fit()
            plans.append(self.patterns)
        self.patterns = min(plans, key=lambda p: sum(times for times, _ in p))

    def _times(self, lengths: list[int]) -> int:
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))

    def _take(self, lengths: list[int]) -> None:
        times = self._times(lengths)
        self.patterns.append((times, lengths))
        for x in lengths:
            self.left[x] -= times
        for x in {x for x in lengths if not self.left[x]}:
            self.pairs[x + np.flatnonzero(self.left)] -= 1
            self.pairs[2 * x] -= 1
            self.left[x] = 0

    def _complement(self, length: int) -> list[int] | None:
        """One, two or three lengths that are left and exactly fill the gap beside length; None if there are none."""
        gap = self.capacity - length
        if gap == 0:
            return []
        if self._times([length, gap]):
            return [gap]
        if self.most >= 2 and self.pairs[gap] and (pair := self._pair(gap, [length])) is not None:
            return pair
        if self.most < 3:
            return None
        thirds = np.flatnonzero((self.left[:gap] > 0) & (self.pairs[gap:0:-1] > 0))
        for third in thirds[np.argsort(np.abs(3 * thirds - gap), kind="stable")]:
            if (pair := self._pair(gap - int(third), [length, int(third)])) is not None:
                return [int(third), *pair]
        return None

    def _pair(self, total: int, beside: list[int]) -> list[int] | None:
        low = np.arange(total // 2, 0, -1)  # evenly split first: the shortest are the best fillers for what is left over
        for a in low[(self.left[low] > 0) & (self.left[total - low] > 0)]:
            pair = [total - int(a), int(a)]
            if self._times([*beside, *pair]):
                return pair
        return None

    def _best_fit(self) -> None:
        """The rest, longest first, each to the fullest sequence with room; equal ones go together."""
        rooms: dict[int, list[tuple[int, list[int]]]] = {}
        for length in range(self.capacity, 0, -1):
            n = int(self.left[length])
            self.left[length] = 0
            while n:
                room = min((r for r in rooms if r >= length), default=None)
                if room is None:
                    each = self.capacity // length
                    for times, lengths in ((n // each, [length] * each), (min(1, n % each), [length] * (n % each))):
                        if times:
                            rooms.setdefault(self.capacity - length * len(lengths), []).append((times, lengths))
                    break
                times, lengths = rooms[room].pop()
                used = min(times, n)
                if used < times:
                    rooms[room].append((times - used, lengths))
                if not rooms[room]:
                    del rooms[room]
                rooms.setdefault(room - length, []).append((used, [*lengths, length]))
                n -= used
        self.patterns += [x for some in rooms.values() for x in some]

    def slots(self) -> np.ndarray:
        """Rows (length, first rank, first sequence, offset), in order: the pieces of a length, by rank, go to a run of sequences each."""
        rank = np.zeros(self.capacity + 1, np.int64)
        rows, sequence = [], 0
        for times, lengths in self.patterns:
            offset = 0
            for length in lengths:
                rows.append((length, rank[length], sequence, offset))
                rank[length] += times
                offset += length
            sequence += times
        return np.array(sorted(rows), np.int64).reshape(-1, 4)


def best_fit_pack(pieces: DataFrame, capacity: int = CAPACITY, tie_cols: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """pieces (any columns, with length from 1 to capacity) with sequence_id and offset.

    Exact complements first: one, two or three lengths that fill the gap beside the longest one left, under the counts of
    what is available; best fit for the rest (Plan tells how many complements it takes at most). Only the histogram of lengths, of at most capacity rows, comes to the driver.
    The pieces of a length are told apart by rank; ranks are counted in buckets, so a length that a third of all pieces
    have is shared out. pieces is read more than once: pass a written table. Columns named like the added ones are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.select(*[c for c in pieces.columns if c.lower() not in {"sequence_id", "offset"}])
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = Plan(histogram, capacity).slots()
    keys = slots[:, 0] << 40 | slots[:, 1]

    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("bucket__", F.pmod(F.xxhash64(*tie_cols), F.lit(buckets)))
    of_length = W.partitionBy("length").orderBy("bucket__")
    base = dealt.groupBy("length", "bucket__").agg(F.count(F.lit(1)).alias("n__"))
    base = base.select("length", "bucket__", (F.sum("n__").over(of_length) - F.col("n__")).alias("base__"))
    within = W.partitionBy("length", "bucket__").orderBy(*tie_cols)
    ranked = dealt.withColumn("nth__", F.row_number().over(within)).join(base, ["length", "bucket__"])
    ranked = ranked.select(*pieces.columns, (F.col("base__") + F.col("nth__") - 1).alias("rank__"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank__"))
            at = np.searchsorted(keys, length.astype(np.int64) << 40 | rank, side="right") - 1
            found = [batch.column(c) for c in names] + [pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3])]
            yield pa.RecordBatch.from_arrays(found, names=[*names, "sequence_id", "offset"])

    names = pieces.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in pieces.dtypes), "sequence_id long", "offset long"])
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Each piece of docs with its place: (id_col, piece, start, length, ids_crc32, sequence_id, offset). Texts are encoded once."""
    pieces = written(token_pieces(docs, file, id_col, text_col, capacity).drop("ids"), "pieces")
    return best_fit_pack(pieces, capacity, (id_col, "piece", "ids_crc32"))
