"""Ranked lexical search, exact: blocks of documents as ball trees over sparse integer impacts, searched best-first by inner product."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmark.llm.common import slices, written

#: Items are searched for in groups of about so many bytes of text: their terms are what one pass over the documents counts.
QUERY_BYTES = 256 << 10
#: Cells (documents x terms) of a block, and documents of it at most; documents of a leaf.
BLOCK_CELLS, BLOCK_DOCS, LEAF_DOCS = 16 << 20, 4096, 32
#: A node has a radius for each of so many groups of terms, alike in frequency: what the sum of the groups' Cauchy-Schwarz bounds
#: is made of, which is closer than one radius over all terms.
TERM_GROUPS = 2048
#: Dimensions of the random projection along which blocks are split. It decides how good the tree is, never what is found.
SPLIT_DIMENSIONS = 16

#: ASCII other than letters and digits parts terms; A-Z are lower-cased; every byte of a character beyond ASCII stays.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and characters beyond ASCII of a UTF-8 text, only A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split() if text else []


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term that comes tf times in a document of this length adds to a score, for a weight of 1. Exact where products pass 64 bits."""
    if int(length.max(initial=0)) * documents * 25 >= 1 << 62:
        m = np.array([75 + 25 * n * documents // total for n in length.tolist()], np.int64)
    else:
        m = 75 + 25 * length * documents // total
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Query:
    """An item's terms by number, with weight times occurrences, and the norm of these in each group of terms."""

    def __init__(self, terms_: np.ndarray, weights: np.ndarray, group_of: np.ndarray, groups: int):
        self.terms, self.weights = terms_, weights
        self.exact = weights.astype(np.float64)
        self.norms = np.sqrt(np.bincount(group_of[terms_], self.exact**2, minlength=groups))


class BallTree:
    """A block of documents: a balanced tree whose nodes have a centroid and radii. An inner product in a node is at most the
    centroid's plus, for each group of terms, the query's norm times the radius; sums in floating point get a slack above any
    rounding error, so that no node is left out that holds a document of the result."""

    def __init__(self, rows: np.ndarray, terms_: np.ndarray, values: np.ndarray, ids: np.ndarray, vocabulary: int, group_of: np.ndarray, groups: int):
        """rows (sorted), terms_ and values: the entries that aren't zero; ids: of the documents, by row."""
        n = len(ids)
        self.levels = max(0, math.ceil(math.log2(max(1, n / LEAF_DOCS))))
        order = self._split(rows, terms_, values, n)
        moved = np.empty(n, np.int64)
        moved[order] = np.arange(n)
        self.ids, rows = ids[order], moved[rows]
        self.dense = np.zeros((n, vocabulary), np.int32)  # impacts are below a million
        self.dense[rows, terms_] = values
        self.bounds_at = [np.arange((1 << level) + 1) * n >> level for level in range(self.levels + 1)]
        # pairs of a document and a group that it has terms of; in other groups a document lies the centroid's norm away
        pairs, pair = np.unique(rows * groups + group_of[terms_], return_inverse=True)
        of, group = np.divmod(pairs, groups)
        squares = np.bincount(pair, values.astype(np.float64) ** 2, minlength=len(pairs))
        starts = np.searchsorted(group_of, np.arange(groups))
        centroids, radii = [], []
        for ends in self.bounds_at:
            sizes = np.diff(ends)
            node = np.repeat(np.arange(len(sizes)), sizes)
            centre = np.bincount(node[rows] * vocabulary + terms_, values, minlength=len(sizes) * vocabulary).reshape(-1, vocabulary) / sizes[:, None]
            norms = np.add.reduceat(centre**2, starts, axis=1)
            place = node[of] * groups + group
            cross = np.bincount(pair, values * centre[node[rows], terms_], minlength=len(pairs))
            all_have = np.bincount(place, minlength=norms.size).reshape(norms.shape) == sizes[:, None]
            far = np.where(all_have, 0, norms * (1 + 1e-9)).ravel()
            near = norms.ravel()[place]
            np.maximum.at(far, place, np.maximum(0, squares - 2 * cross + near) + 1e-9 * (squares + 2 * cross + near))
            radii.append(np.sqrt(far).reshape(norms.shape))
            centroids.append(centre)
        self.centroids, self.radii = np.concatenate(centroids), np.concatenate(radii)

    def _split(self, rows: np.ndarray, terms_: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Documents in the order of the leaves: each node is halved along the line between two documents far apart."""
        directions = np.random.default_rng(11).standard_normal((int(terms_.max(initial=0)) + 1, SPLIT_DIMENSIONS))
        sketch = np.stack([np.bincount(rows, values * directions[terms_, d], minlength=n) for d in range(SPLIT_DIMENSIONS)], axis=1)
        order = np.arange(n)
        for level in range(self.levels):
            ends = np.arange((1 << level) + 1) * n >> level
            halves = np.arange((2 << level) + 1) * n >> (level + 1)
            for j in range(1 << level):
                own = order[ends[j] : ends[j + 1]]
                points = sketch[own]
                far = points[((points - points[0]) ** 2).sum(1).argmax()]
                other = points[((points - far) ** 2).sum(1).argmax()]
                order[ends[j] : ends[j + 1]] = own[np.argpartition(points @ (other - far), halves[2 * j + 1] - halves[2 * j])] if len(own) > 1 else own
        return order

    def upper_bounds(self, query: Query) -> np.ndarray:
        """For each node, level by level, what no document in it scores above."""
        return (self.centroids[:, query.terms] @ query.exact + self.radii @ query.norms) * (1 + 1e-9) + 1

    def search(self, query: Query, best: Best) -> int:
        """Put into best what belongs there; how many documents were scored for it."""
        bounds, scored = self.upper_bounds(query), 0
        heap = [(-bounds[0], 0, 0)]
        while heap:
            bound, level, j = heapq.heappop(heap)
            if -bound < best.least:
                break  # every other node's bound is lower still
            if level < self.levels:
                for child in (2 * j, 2 * j + 1):
                    b = bounds[(2 << level) - 1 + child]
                    if b >= best.least:
                        heapq.heappush(heap, (-b, level + 1, child))
                continue
            own = slice(self.bounds_at[level][j], self.bounds_at[level][j + 1])
            best.offer(self.dense[own][:, query.terms].astype(np.int64) @ query.weights, self.ids[own])
            scored += own.stop - own.start
        return scored


class Best:
    """The k highest positive scores so far, equal ones by id, null ids (the largest of long) last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.least = k, np.zeros(0, np.int64), np.zeros(0, np.int64), 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids = np.r_[self.scores, scores[good]], np.r_[self.ids, ids[good]]
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[top], ids[top]
        if len(top) == self.k:
            self.least = int(self.scores[-1])


NULL_ID = np.iinfo(np.int64).max


def _term_counts(docs: DataFrame, id_col: str, text_col: str, numbers: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: how many terms it has, and those of them that numbers has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, lengths, found, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                words = terms(text.as_py())
                if words:
                    known = [(numbers[t], c) for t, c in Counter(words).items() if t in numbers]
                    kept.append(i)
                    lengths.append(len(words))
                    found += [t for t, _ in known]
                    counts += [c for _, c in known]
                    ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(kept, pa.int32())), pa.array(lengths, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "id long, n long, terms array<int>, tfs array<int>")


def _groups(items: DataFrame) -> int:
    """Into how many groups items (row, n_bytes) go by a hash, so that none is above QUERY_BYTES, or each item is alone."""
    total, most = items.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.max("n_bytes"), F.lit(0))).first()
    groups = max(1, math.ceil(total / (QUERY_BYTES / 2))) if total > QUERY_BYTES else 1
    while groups > 1:
        by = items.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups))).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        if by.where((F.col("b") > max(QUERY_BYTES, most)) & (F.col("n") > 1)).isEmpty():
            break
        groups *= 2
    return groups


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_col, rank, id_col, score): the k documents that score highest above 0 for each item, exactly.

    Terms, weights and scores are those of term_weight and impacts: a score sums weight times impact over the item's terms, repeats
    included, in 64-bit integers. Items go in groups of bounded text; for a group, one pass over the documents counts the group's terms
    in every text, and one pass over these counts builds ball trees of bounded size and searches them, each task carrying every
    item's best along, so that later blocks begin with a high bar. A row of the result is settled by the ranks of all tasks' best.

    Null texts and texts without a term count as no document. Each row of docs is a document and each of items an item, repeated
    ids or texts too; equal scores go by ascending id, null ids last. An item without a term that a document has gets no row.
    Empty tables give no rows. Ids of documents are read as long; columns other than the four are not read.
    """
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"), F.monotonically_increasing_id().alias("row")), "items")
    sized = asked.select("row", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    groups, parts = _groups(sized), []
    for g in range(groups):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == g)
        bags = {r["row"]: Counter(terms((r["text"] or "").encode())) for r in own.select("row", "text").toLocalIterator()}  # QUERY_BYTES, or one item
        numbers = {t: i for i, t in enumerate(sorted(set().union(*bags.values())))}
        counted = written(_term_counts(docs, id_col, text_col, numbers), "term-counts")
        documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(numbers), np.int64)
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term of the group
            df[r["term"]] = r["count"]
        parts.append(_search(counted, bags, numbers, df, documents, total, k))
    if not parts:
        return spark.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = W.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("row", "item"), "row").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search(counted: DataFrame, bags: dict[int, Counter], numbers: dict[bytes, int], df: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """(row, id, score): each task's best for each item."""
    weights = np.array([term_weight(documents, n) if n else 0 for n in df.tolist()], np.int64)
    # terms in order of their frequency, without those that add nothing; groups of terms are runs of it
    used = np.flatnonzero(weights)
    by_df = used[np.argsort(df[used], kind="stable")]
    rank = np.full(len(df), -1)
    rank[by_df] = np.arange(len(by_df))
    groups = min(TERM_GROUPS, len(by_df))
    group_of = np.arange(len(by_df)) * groups // max(1, len(by_df))
    queries = []
    for row, bag in bags.items():
        known = [(rank[numbers[t]], c * weights[numbers[t]]) for t, c in bag.items() if rank[numbers[t]] >= 0]
        if known:
            queries.append((row, Query(np.array([t for t, _ in known]), np.array([w for _, w in known], np.int64), group_of, groups)))
    schema = "row long, id long, score long"
    if not queries:
        return counted.sparkSession.createDataFrame([], schema)
    block_docs = max(1, min(BLOCK_DOCS, BLOCK_CELLS // len(by_df)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for rows, terms_, values, ids in _blocks(batches, rank, block_docs, documents, total):
            tree = BallTree(rows, terms_, values, ids, len(by_df), group_of, groups)
            for (_, query), top in zip(queries, best, strict=True):
                tree.search(query, top)
        for (row, _), top in zip(queries, best, strict=True):
            ids = pa.array(top.ids, mask=top.ids == NULL_ID)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row)), ids, pa.array(top.scores)], names=["row", "id", "score"])

    return counted.select("id", "n", "terms", "tfs").where(F.size("terms") > 0).mapInArrow(search, schema)


def _blocks(batches: Iterator[pa.RecordBatch], rank: np.ndarray, size: int, documents: int, total: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, terms, impacts, ids) of so many documents at a time."""
    held: list[pa.RecordBatch] = []

    def made() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, n, lists, tfs = (table.column(c).combine_chunks() for c in ("id", "n", "terms", "tfs"))
        sizes = np.diff(lists.offsets.to_numpy())
        rows, terms_ = np.repeat(np.arange(len(n)), sizes), rank[lists.flatten().to_numpy()]
        values = impacts(tfs.flatten().to_numpy().astype(np.int64), np.repeat(n.to_numpy(), sizes), documents, total)
        some = terms_ >= 0
        return rows[some], terms_[some], values[some], ids.fill_null(NULL_ID).to_numpy()

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            take = min(batch.num_rows - at, size - sum(b.num_rows for b in held))
            held.append(batch.slice(at, take))
            at += take
            if sum(b.num_rows for b in held) == size:
                yield made()
                held = []
    if held:
        yield made()
