"""Removal of passages that repeat across documents, by anchors on fixed blocks of words.

A repeat of WINDOW words in an earlier document holds a whole block of ANCHOR words that starts at a multiple of ANCHOR there,
as WINDOW is at least 2 * ANCHOR - 1. So the blocks of every document, one in ANCHOR of its word runs, are the index; every
rolling run of ANCHOR words probes it; and hits are extended to windows, whose earliest document decides.

Both exchanges go by hash. A row is all that one pass over some documents has for one shard: hashes in order, the anchors' by
their low 16 bits and high 16 bits apart, which compress well, and the number in the pass of the document each stands in.
Answers go back by pass, where the numbers become documents again. What many documents of a pass have goes once for all of
them, so a passage of a third of all documents adds one entry a pass, not one a document.

An anchor is told by its shard and 32 bits; a false hit costs an extension, never a wrong result. Windows are told by two
64-bit hashes of their words. There are as many shards as make one hold about SHARD_BYTES of text, so neither what a task
holds nor the share of false hits grows with the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmark.llm import words
from glossmark.llm.common import bloom_blocks, bloom_filter, bloom_probe, fresh, give_back, slices, written

WINDOW_WORDS = 13
ANCHOR_WORDS = 7
SHARD_BYTES = 32 << 20
#: Characters of a pass: what a worker holds as numbers at a time. A longer text is a pass of its own.
PASS_CHARS = 2 << 20
#: A shard's rows are compared in 2 ** PART_BITS parts, by bits of their hashes: what a worker sorts at a time is a part.
PART_BITS = 4
#: For the second hash of windows.
_SECOND = 0xC2B2AE3D27D4EB4F

_ANCHOR_ROW = "shard int, pass long, low binary, high binary, owner binary, block binary, several binary"
_WINDOW_ROW = "shard int, pass long, base long, hash binary, second binary, owner binary, place binary, id binary"
_ANSWER = "pass long, keys binary, owner binary, value binary"


def _groups(*sorted_: np.ndarray) -> np.ndarray:
    """Where a new value of the sorted columns begins."""
    new = np.ones(len(sorted_[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_])
    return new


def _row(schema: str, shard: int, *columns) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    values = [shard, *(c.tobytes() if isinstance(c, np.ndarray) else c for c in columns)]
    arrow = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], arrow[k]) for v, k in zip(values, kinds, strict=True)], names=list(names))


def _pass_name(keys: np.ndarray) -> int:
    return words.xxhash.xxh64_intdigest(keys.tobytes()) - (1 << 63)


def _aside(name: int, shards: int) -> int:
    """A shard below 0, for what needs no comparison and is only on its way back to its pass."""
    return -1 - name % shards


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    """By the upper half of the hashes, in their order."""
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _anchors(shards: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each shard what this pass has of it; aside, the pass's documents and the anchors known here to repeat."""
        for batch in slices(batches, 1024):
            texts = batch.column("text").to_pylist()
            for some in words.passes(texts, PASS_CHARS):
                ids, keys = (batch.column(c).slice(some.start, len(some)).to_numpy() for c in ("id", "key"))
                by_id = np.argsort(ids, kind="stable").astype(np.uint16)
                rank = np.empty(len(ids), np.uint16)
                rank[by_id] = np.arange(len(ids))
                runs = [words.rolling(words.hashes(words.split(texts[i])), ANCHOR_WORDS) for i in some]
                sizes = [len(x) for x in runs]
                h = np.concatenate(runs)
                if not len(h):
                    continue
                name = _pass_name(keys)
                yield _row(_ANCHOR_ROW, _aside(name, shards), name, keys, None, None, None, None)
                block = np.concatenate([np.arange(n) % ANCHOR_WORDS == 0 for n in sizes])
                order = np.argsort(h)
                h, rank, block = h[order], np.repeat(rank, sizes)[order], block[order]
                first = np.flatnonzero(_groups(h))
                least, most = np.minimum.reduceat(rank, first), np.maximum.reduceat(rank, first)
                several = least != most
                if several.any():
                    again = np.repeat(several, np.diff(np.r_[first, len(h)]))
                    yield _row(_ANCHOR_ROW, _aside(name, shards), name, None, h[again].astype(np.uint32), by_id[rank[again]], None, None)
                h, block, owner = h[first], np.logical_or.reduceat(block, first), by_id[least]
                shard = _shard(h, shards)
                cuts = np.flatnonzero(_groups(shard))
                for a, b in zip(cuts, np.r_[cuts[1:], len(h)], strict=True):
                    yield _row(_ANCHOR_ROW, int(shard[a]), name, h[a:b].astype(np.uint16), (h[a:b] >> np.uint64(16)).astype(np.uint16), owner[a:b], np.packbits(block[a:b]), np.packbits(several[a:b]))

    return entries


def _columns(table: pa.Table, *kinds: tuple[str, type]) -> list[list[np.ndarray]]:
    """Each row's numbers, as they lie in the table."""
    return [[np.frombuffer(x.as_buffer(), k) for x in table.column(c)] for c, k in kinds]


def _rows_of(columns: list[np.ndarray]) -> np.ndarray:
    """Of each number of the columns, which row it stands in."""
    return np.repeat(np.arange(len(columns), dtype=np.uint32), [len(x) for x in columns])


def _parts(part: np.ndarray) -> Iterator[np.ndarray]:
    """The places of each part that isn't empty."""
    for k in range(1 << PART_BITS):
        here = np.flatnonzero(part == k)
        if len(here):
            yield here


def _answers(names: list[int], keys: list, owners: list, values: list) -> pa.Table:
    packed = [pa.array([x.tobytes() if isinstance(x, np.ndarray) else x for x in some], pa.binary()) for some in (keys, owners, values)]
    return pa.table([pa.array(names, pa.int64()), *packed], names=[c.split()[0] for c in _ANSWER.split(", ")])


def _by_pass(names: list[int], of: np.ndarray, owner: np.ndarray, value: np.ndarray) -> pa.Table:
    """The entries, with the number of their row in of, as one answer to each row's pass."""
    order = np.argsort(of, kind="stable")
    of, owner, value = of[order], owner[order], value[order]
    cuts = np.flatnonzero(_groups(of)) if len(of) else np.zeros(0, int)
    ends = np.r_[cuts[1:], len(of)] if len(of) else cuts
    return _answers([names[of[a]] for a in cuts], [None] * len(cuts), [owner[a:b] for a, b in zip(cuts, ends, strict=True)], [value[a:b] for a, b in zip(cuts, ends, strict=True)])


def _probe(table: pa.Table) -> pa.Table:
    """Of one shard: the anchors that stand in several documents, in one of them as a block; to each pass, those it has."""
    names = table.column("pass").to_pylist()
    if table.column("shard")[0].as_py() < 0:
        return _answers(names, table.column("low").to_pylist(), table.column("owner").to_pylist(), table.column("high").to_pylist())
    lows, highs, owners, blocks, severals = _columns(table, ("low", np.uint16), ("high", np.uint16), ("owner", np.uint16), ("block", np.uint8), ("several", np.uint8))
    low, high, owner, of = np.concatenate(lows), np.concatenate(highs), np.concatenate(owners), _rows_of(lows)
    block, several = (np.concatenate([np.unpackbits(x, count=len(y)) for x, y in zip(some, lows, strict=True)]).view(bool) for some in (blocks, severals))
    found = []
    for here in _parts(high >> np.uint16(16 - PART_BITS)):
        value = high[here].astype(np.uint32) << np.uint32(16) | low[here]
        order = np.argsort(value, kind="stable")
        value, here = value[order], here[order]
        first = np.flatnonzero(_groups(value))
        sizes = np.diff(np.r_[first, len(value)])
        repeats = ((sizes > 1) | np.logical_or.reduceat(several[here], first)) & np.logical_or.reduceat(block[here], first)
        hit = np.repeat(repeats, sizes)
        found.append((of[here[hit]], owner[here[hit]], value[hit]))
    del low, high, owner, of, block, several
    return _by_pass(names, *(np.concatenate(x) for x in zip(*found, strict=True)))


def _by_document(table: pa.Table) -> pa.Table:
    """Of one pass: its documents' keys, each with the values that came back for it."""
    keys = next(np.frombuffer(x, np.int64) for x in table.column("keys").to_pylist() if x is not None)
    answers = table.filter(pa.compute.is_valid(table.column("owner")))
    rows = ([], [])
    if answers.num_rows:
        owner, value = (np.concatenate(x) for x in _columns(answers, ("owner", np.uint16), ("value", np.uint32)))
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
        cuts = np.flatnonzero(_groups(owner))
        rows = keys[owner[cuts]].tolist(), [value[a:b].tobytes() for a, b in zip(cuts, np.r_[cuts[1:], len(owner)], strict=True)]
    return pa.table({"key": pa.array(rows[0], pa.int64()), "found": pa.array(rows[1], pa.binary())})


def _windows(shards: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hits extended: each window that covers a hit, by shard of its own hash; aside, the pass's documents and the windows that an
        earlier document of the pass has too, which are settled."""
        for batch in slices(batches, 1024):
            texts, hits = batch.column("text").to_pylist(), batch.column("hits").to_pylist()
            for some in words.passes(texts, PASS_CHARS):
                ids, keys = (batch.column(c).slice(some.start, len(some)).to_numpy() for c in ("id", "key"))
                owners, places, hashes, seconds = [], [], [], []
                for i in some:
                    h = words.hashes(words.split(texts[i]))
                    hit = np.isin(words.rolling(h, ANCHOR_WORDS).astype(np.uint32), np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in hits[i]])))
                    w = len(h) - WINDOW_WORDS + 1
                    if w > 0 and hit.any():
                        seen = np.r_[0, np.cumsum(hit)]
                        span = WINDOW_WORDS - ANCHOR_WORDS + 1
                        starts = np.flatnonzero(seen[span : span + w] > seen[:w])
                        owners.append(np.full(len(starts), i - some.start, np.uint16))
                        places.append(starts.astype(np.uint32))
                        hashes.append(words.rolling(h, WINDOW_WORDS)[starts])
                        seconds.append(words.rolling(h, WINDOW_WORDS, _SECOND)[starts])
                if not hashes or not sum(map(len, hashes)):
                    continue
                name, base = _pass_name(keys), int(ids.min())
                yield _row(_WINDOW_ROW, _aside(name, shards), name, base, keys, None, None, None, None)
                owner, place, h, second = (np.concatenate(x) for x in (owners, places, hashes, seconds))
                order = np.lexsort((ids[owner], second, h))
                owner, place, h, second = owner[order], place[order], h[order], second[order]
                new = _groups(h, second)
                later = ids[owner] != ids[owner[np.flatnonzero(new)]][np.cumsum(new) - 1]
                if later.any():
                    yield _row(_WINDOW_ROW, _aside(name, shards), name, base, None, None, owner[later], place[later], None)
                owner, place, h, second = (x[~later] for x in (owner, place, h, second))
                offset = ids[owner] - base
                offset = offset.astype(np.uint32 if offset.max() < 1 << 32 else np.uint64)
                shard = _shard(h, shards)
                cuts = np.flatnonzero(_groups(shard))
                for a, b in zip(cuts, np.r_[cuts[1:], len(h)], strict=True):
                    yield _row(_WINDOW_ROW, int(shard[a]), name, base, h[a:b], second[a:b], owner[a:b], place[a:b], offset[a:b])

    return entries


def _later(table: pa.Table) -> pa.Table:
    """Of one shard: the windows that an earlier document has; to each pass, where its documents have them."""
    names = table.column("pass").to_pylist()
    if table.column("shard")[0].as_py() < 0:
        return _answers(names, table.column("hash").to_pylist(), table.column("owner").to_pylist(), table.column("place").to_pylist())
    hashes, seconds, owners, places = _columns(table, ("hash", np.uint64), ("second", np.uint64), ("owner", np.uint16), ("place", np.uint32))
    offsets = [np.frombuffer(x.as_buffer(), np.uint32 if len(x.as_buffer()) == 4 * len(h) else np.uint64) for x, h in zip(table.column("id"), hashes, strict=True)]
    ids = np.concatenate([x.astype(np.int64) + base for x, base in zip(offsets, table.column("base").to_pylist(), strict=True)])
    of = _rows_of(hashes)
    hash_, second, owner, place = (np.concatenate(x) for x in (hashes, seconds, owners, places))
    found = []
    for here in _parts((hash_ & np.uint64((1 << PART_BITS) - 1)).astype(np.uint8)):
        here = here[np.lexsort((second[here], hash_[here]))]
        first = np.flatnonzero(_groups(hash_[here], second[here]))
        id_ = ids[here]
        late = here[id_ > np.repeat(np.minimum.reduceat(id_, first), np.diff(np.r_[first, len(here)]))]
        found.append((of[late], owner[late], place[late]))
    del ids, of, hash_, second, owner, place
    return _by_pass(names, *(np.concatenate(x) for x in zip(*found, strict=True)))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(key, places): for each document of docs (id long, key long, text) the starts of its windows that a smaller id has too."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHARD_BYTES))
    hits = _answered(docs.mapInArrow(_anchors(shards), _ANCHOR_ROW), _probe, "hits")
    extended = _chosen(docs, hits.select("key")).join(hits, "key").select("id", "key", "text", "hits")
    return _answered(extended.mapInArrow(_windows(shards), _WINDOW_ROW), _later, "places")


def _lean(judge):
    def judged(table: pa.Table) -> pa.Table:
        """judge, and then what it held in reserve is given back: the worker's next group may be long in coming."""
        out = judge(table)
        give_back()
        return out

    return judged


def _answered(entries: DataFrame, judge, name: str) -> DataFrame:
    """(key, name): to the shards, back to the passes, and out to the documents."""
    answers = entries.groupBy("shard").applyInArrow(_lean(judge), _ANSWER)
    found = answers.groupBy("pass").applyInArrow(_lean(_by_document), "key long, found binary")
    return written(found.groupBy("key").agg(F.collect_list("found").alias(name)), name)


def _chosen(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key may be among keys, by a Bloom filter: a join with them then shuffles few others."""
    blocks = bloom_blocks(keys.count(), 16)
    return bloom_probe(docs, "key", written(bloom_filter(keys, "key", blocks, 2), "keys-filter"), blocks, 2, "chosen").where("chosen").drop("chosen")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with n_words, n_removed and kept_text: the words that no repeated window covers, joined by one space.

    A window is 13 consecutive words of a document; it is repeated if the same words stand, in order, in a document with a
    smaller id; windows are held against each other by two 64-bit hashes. All windows are judged on the input. Maximal repeats are the unions of such windows. Ids must be integers; a
    null id is neither smaller nor larger than another, so nothing is removed there or on its account. Rows that repeat an id
    don't count against each other. Null and empty texts have no words. Columns named like the added ones are replaced.
    """
    keep = [c for c in docs.columns if c.lower() not in {"n_words", "n_removed", "kept_text"}]
    docs = docs.select(*keep)
    key, places = fresh(docs, "key__"), fresh(docs, "places__")
    keyed = docs.withColumn(key, F.xxhash64(id_col, text_col))
    plain = keyed.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(key).alias("key"), F.col(text_col).alias("text"))
    repeated = repeated_windows(plain).select(F.col("key").alias(key), F.col("places").alias(places))

    flag = fresh(docs, "cut__")
    blocks = bloom_blocks(repeated.count(), 16)
    found = bloom_probe(keyed, key, written(bloom_filter(repeated.select(key), key, blocks, 2), "cut-filter"), blocks, 2, flag)
    word = r"[^\x20\x09-\x0D]+"
    n_words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(word)).cast("long")
    joined = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " "))
    whole = found.where(~F.col(flag)).select(*keep, n_words.alias("n_words"), F.lit(0).cast("long").alias("n_removed"), joined.alias("kept_text"))

    @F.arrow_udf("struct<n_words: long, n_removed: long, kept_text: string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for some in slices(pa.RecordBatch.from_arrays(list(columns), names=["text", "runs"]) for columns in batches):
            rows = []
            for text, places in zip(*(c.to_pylist() for c in some.columns), strict=True):
                found = words.split(text)
                covered = np.zeros(len(found) + 1, np.int64)
                for run in places or []:
                    starts = np.frombuffer(run, np.uint32).astype(np.int64)
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + WINDOW_WORDS, -1)
                gone = np.cumsum(covered)[: len(found)] > 0
                rows.append((len(found), int(gone.sum()), " ".join(w for w, g in zip(found, gone.tolist(), strict=True) if not g)))
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)], names=["n_words", "n_removed", "kept_text"])

    # Not deterministic, so that it is computed once a row: else a filter on its columns is moved below it with a call of its own, by a second Python worker in each task.
    parted = found.where(flag).drop(flag).join(repeated, key, "left").select(*keep, cut.asNondeterministic()(text_col, places).alias(flag))
    return whole.unionByName(parted.select(*keep, f"{flag}.*"))
