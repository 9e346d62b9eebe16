"""Approximate nearest neighbours by inner product, by counting collisions in query-centred windows of single projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from glossmark.llm.common import written

#: Sorted arrays of a block, and those that take part in a search: where the query lies farthest from the centre, as a window there
#: holds few of the vectors that are unlike it.
PROJECTIONS, SEARCHED = 512, 64
#: A vector is verified when this share of the searched arrays have it in their window.
COLLISIONS = 0.5
#: Windows go on until a vector as near as the k-th found would have been verified, with so many standard deviations to spare.
SURETY = 0.65
#: The first radius, and the factor it grows by; the larger one while fewer than k vectors are verified.
FIRST_RADIUS, GROWTH, FAST_GROWTH = 0.8, 1.08, 1.25
#: Exponents (of two) of a block's largest component and a query's, added up, between which products and their sums are normal doubles.
LEAST_EXPONENT, LARGEST_EXPONENT = -960, 1000
#: Candidates of a block, on average. Blocks are dealt out by a hash of a row number, so a block doesn't come near 65,536, what ranks of 16 bits tell apart.
BLOCK = 16384
#: A block is copied once for every so many queries, which is more work than the copy.
QUERY_GROUP = 65536


def _normal(x: np.ndarray) -> np.ndarray:
    """The standard normal distribution function, to about 1e-4, which is enough for a rule of when to stop."""
    return 0.5 * (1 + np.sign(x) * np.sqrt(1 - np.exp(-np.square(x) * 2 / np.pi)))


class Block:
    """Candidates with their projections, each in a sorted array of its own.

    Vectors are scaled by the block's largest norm and lifted by one coordinate to norm 1, so that the inner product with the query's
    direction is all that tells how near they are; at rho, a projection is normal around rho times the query's, with variance 1 - rho^2. A window
    of R to each side of the query serves every R: a larger one goes on to both sides (virtual rehashing), and only the ranks
    that are new in it are counted. Scaling goes by powers of two first, so no norm is out of range, however large or small components are."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        self.ids, self.vectors, self.m = ids, vectors.astype(np.float64), projections
        n = len(ids)
        if n > 1 << 16:
            raise ValueError("a block holds at most 65,536 vectors")
        self.exponent = int(np.frexp(np.abs(self.vectors).max())[1])
        self.small = np.ldexp(self.vectors, -self.exponent)
        self.small /= math.sqrt((self.small**2).sum(1).max()) * (1 + 1e-12)
        self.directions = np.random.default_rng(20).standard_normal((vectors.shape[1] + 1, projections))
        small = self.small
        lift = np.sqrt(np.maximum(0, 1 - (small**2).sum(1)))
        self.order = np.empty((projections, n), np.uint16)
        places = np.empty((projections, n))
        for j in range(0, projections, 64):  # a few at a time, for memory
            h = (small @ self.directions[:-1, j : j + 64] + lift[:, None] * self.directions[-1, j : j + 64]).T
            order = np.argsort(h, axis=1, kind="stable")
            self.order[j : j + 64], places[j : j + 64] = order, np.take_along_axis(h, order, axis=1)
        # the arrays one after the other, far enough apart that one search serves all
        self.apart = 4 * (np.abs(places).max(initial=0) + 100)
        self.sorted = (places + (np.arange(projections) * self.apart)[:, None]).ravel()

    def _sure(self, at: np.ndarray, radius: float, rho: float, enough: int) -> bool:
        """Whether windows of this radius count a vector at rho as often as enough, but for little chance."""
        spread = math.sqrt(max(1e-12, 1 - rho * rho))
        p = _normal((at + radius - rho * at) / spread) - _normal((at - radius - rho * at) / spread)
        return p.sum() - enough + 0.5 >= SURETY * math.sqrt((p * (1 - p)).sum())

    def nearest(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, verified): the k largest inner products found, ties to the smaller id, and how many vectors were verified
        for them; rows with the id own don't count."""
        n, query = len(self.ids), query.astype(np.float64)
        exponent = int(np.frexp(np.abs(query).max())[1])
        if not LEAST_EXPONENT < exponent + self.exponent < LARGEST_EXPONENT:
            return self._plainly(own, query, k)
        direction = np.ldexp(query, -exponent)
        direction /= math.sqrt((direction**2).sum())
        at = direction @ self.directions[:-1]
        chosen = np.argsort(-np.abs(at), kind="stable")[:SEARCHED]
        at, base, shift = at[chosen], chosen * n, chosen * self.apart
        enough = max(1, math.ceil(COLLISIONS * len(chosen)))
        verified, counts = self.ids == own, np.zeros(n, np.int64)
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        total = n - int(verified.sum())
        k, radius = min(k, total), FIRST_RADIUS
        left = right = np.clip(np.searchsorted(self.sorted, at + shift) - base, 0, n)
        while k:
            wide = np.clip(np.searchsorted(self.sorted, np.stack([at - radius + shift, np.nextafter(at + radius, np.inf) + shift])) - base, 0, n)
            spans = [self.order[j, a:b] for j, new, l, r, end in zip(chosen.tolist(), wide[0].tolist(), left.tolist(), right.tolist(), wide[1].tolist(), strict=True) for a, b in ((new, l), (r, end)) if a < b]
            left, right = np.minimum(wide[0], left), np.maximum(wide[1], right)
            if spans:
                counts += np.bincount(np.concatenate(spans), minlength=n)
            fresh = np.flatnonzero((counts >= enough) & ~verified)
            verified[fresh] = True
            found = np.r_[found, fresh]
            scores = np.r_[scores, self.small[fresh] @ direction]
            if len(found) == total:
                break
            if len(found) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                if self._sure(at, radius, min(1.0, kth), enough):
                    break
                radius *= GROWTH
            else:
                radius *= FAST_GROWTH if len(found) < k // 2 else GROWTH
        seen = len(found)
        # equal vectors must tie exactly, so the best are summed once more, in an order that their place doesn't change
        if k:
            found = found[scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - 1e-9]
        scores = (self.vectors[found] * query).sum(1)
        best = np.lexsort((self.ids[found], -scores))[:k]
        return self.ids[found[best]], scores[best], seen

    def _plainly(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """All vectors verified: where products leave the range of doubles, scores are infinite or 0, and ids decide. What isn't a number comes last."""
        found = np.flatnonzero(self.ids != own)
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            scores = (self.vectors[found] * query).sum(1)
        best = np.lexsort((self.ids[found], -scores, np.isnan(scores)))[:k]
        return self.ids[found[best]], scores[best], len(found)


def _log_norm() -> Column:
    """The logarithm to base 2 of a vector's norm, whatever its components' size."""
    most = F.array_max(F.transform("vector", lambda x: F.abs(x)))

    def scaled(m: Column) -> Column:  # m is computed once a vector, not once a component
        return F.log2(m) + 0.5 * F.log2(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / m) * (x / m)))

    return F.get(F.transform(F.array(most), scaled), F.lit(0))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): without null ids and vectors that are null, empty, zero or hold null or non-finite components."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector"))


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): the k largest inner products found for each row that is_query, a condition on id, holds for.

    Candidates are dealt into blocks of about BLOCK by the octave of their norm, each block in one place; queries go to every block, and are streamed past its
    index, so a task holds one block and a few queries. A block's vectors that collide with a query often enough are
    verified, and the best of all blocks are ranked. Scores are in double precision on the original vectors; ties go to the
    smaller id. Vectors that usable() leaves out take no part, nor do those of another length than the most common one (the
    shorter, if several are). Rows with the query's own id are no candidates; rows that repeat an id or a vector each count. An
    empty table gives no rows. Columns other than the two are not read.
    """
    good = usable(vectors, id_col, vector_col).select("id", "vector", _log_norm().alias("log_norm"), F.monotonically_increasing_id().alias("row"))
    good = written(good, "vectors")
    sizes = good.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query(F.col("id"))).alias("queries"), F.percentile_approx("log_norm", 0.5).alias("middle")).orderBy(F.desc("n"), "size").take(1)
    if not sizes:
        return good.sparkSession.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    size, groups = sizes[0]["size"], max(1, math.ceil(sizes[0]["queries"] / QUERY_GROUP))
    # vectors of like norms share blocks, each with a scale of its own: a few long ones don't blur the others
    good = good.where(F.size("vector") == size).withColumn("octave", F.floor(F.col("log_norm") - sizes[0]["middle"] + 0.5).cast("int"))
    octaves, blocks, first, share = good.groupBy("octave").count().collect(), 0, [], []  # doubles have some 2,100 octaves
    for r in octaves:
        first += [F.lit(r["octave"]), F.lit(blocks)]
        share += [F.lit(r["octave"]), F.lit(math.ceil(r["count"] / BLOCK))]
        blocks += math.ceil(r["count"] / BLOCK)
    own_block = (F.create_map(*first)[F.col("octave")] + F.pmod(F.xxhash64("row"), F.create_map(*share)[F.col("octave")])).cast("int")
    to_all = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    hashed = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    candidates = good.select("id", "vector", F.lit(False).alias("query"), own_block.alias("block"), to_all(groups).alias("group"))
    queries = good.where(is_query(F.col("id"))).select("id", "vector", F.lit(True).alias("query"), to_all(blocks).alias("block"), hashed(groups).alias("group"))
    dealt = candidates.unionByName(queries).select("id", "vector", "query", (F.col("group") * blocks + F.col("block")).alias("place"))
    dealt = dealt.repartitionById(blocks * groups, "place").sortWithinPartitions("place", "query")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, index = None, [], None
        for batch in batches:
            at, ask, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "query", "id"))
            all_ = batch.column("vector").flatten().to_numpy().reshape(-1, size)
            cuts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (ask[1:] != ask[:-1])]) if len(at) else []
            for a, b in zip(cuts, np.r_[cuts[1:], len(at)], strict=True):
                if at[a] != place:
                    place, held, index = at[a], [], None
                if not ask[a]:
                    held.append((ids[a:b], all_[a:b].copy()))
                    continue
                if index is None and held:
                    index, held = Block(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                if index is not None:
                    found = [(i, *index.nearest(i, v, k)) for i, v in zip(ids[a:b], all_[a:b], strict=True)]
                    columns = (np.concatenate([np.full(len(f[1]), f[0]) for f in found]), np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", id_col, "score"])

    found = dealt.mapInArrow(search, f"query_id long, {id_col} long, score double")
    best = W.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), id_col)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
