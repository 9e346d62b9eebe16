"""Near-duplicate classes by DartMinHash signatures of weighted word shingles, banded joining and exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmark.llm import words
from glossmark.llm.common import bloom_blocks, bloom_filter, bloom_probe, join_groups, slices, written

SHINGLE_WORDS, THRESHOLD = 5, 0.8
#: 24 bands of 5 coordinates: a pair of similarity 0.8 shares none of them with a chance of 7 in 100,000.
BANDS, BAND_ROWS = 24, 5
#: Four bits of each coordinate make a sketch. At similarity 0.8 two sketches differ in more than MAX_UNLIKE of them with a chance
#: of 7 in 100,000 too; such pairs are not looked at.
COORDINATES, MAX_UNLIKE = 368, 97
#: A unit column throws Poisson(1) darts at each area, a span of ranks of length one. Sixteen bits of a hash give their number.
COUNTS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(n) for n in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
#: Darts a document throws at first, and each time that a coordinate is still empty; it takes COORDINATES * (ln(COORDINATES) + 0.6) on average.
FIRST_DARTS, MORE_DARTS = 4 * COORDINATES, 3 * COORDINATES // 2
#: (element, area) pairs thrown at in one go, so that their arrays stay in a processor's cache, however long a text is.
AREAS_AT_ONCE = 1 << 14
#: Low bits of a dart in a signature: its place within its area. Those above are the area.
PLACE_BITS = 40
NONE = np.uint64(2**64 - 1)
#: Members of a leader that one copy of the leader's elements is joined with.
MEMBERS_PER_COPY = 500
#: What one numpy pass takes: about so many characters, and so many documents; a longer text is a pass of its own.
PASS_CHARS, PASS_DOCUMENTS = 1 << 19, 64


def elements(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document, element) of all texts: a document's weighted shingles as unit columns, one for each occurrence of a shingle.

    The weight of a shingle is its count, so the columns m = 0, 1, ... up to the weight are the elements, and the weighted
    Jaccard similarity of two documents is the plain one of their elements. A text of one to four words is one shingle."""
    found, owners = [], []
    for i, text in enumerate(texts):
        h = words.hashes(words.split(text))
        if len(h):
            s = words.rolling(h, min(SHINGLE_WORDS, len(h)))
            found.append(s)
            owners.append(np.full(len(s), i, np.int64))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner, shingle = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])]
    first = np.flatnonzero(new)
    occurrence = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    return owner, words.mix(shingle + occurrence.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def _count_up(n: np.ndarray) -> np.ndarray:
    """0, 1, ... below each number of n in turn."""
    end = np.cumsum(n)
    return np.arange(end[-1]) - np.repeat(end - n, n)


def _throw(lowest: np.ndarray, owner: np.ndarray, element: np.ndarray, first: np.ndarray, areas: np.ndarray) -> None:
    """Throw each element's darts at so many areas from its first; lowest, flat, keeps the lowest dart of each document's coordinates."""
    area = (np.repeat(first, areas) + _count_up(areas)).astype(np.uint64)
    seed = words.mix(np.repeat(element, areas) + area * np.uint64(0x9E3779B97F4A7C15))
    n = COUNTS[(seed >> np.uint64(48)).astype(np.int64)].astype(np.int64)
    dart = words.mix(np.repeat(seed, n) + _count_up(n).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    cell = ((dart >> np.uint64(32)) * np.uint64(COORDINATES) >> np.uint64(32)).astype(np.int64)
    cell += np.repeat(np.repeat(owner * COORDINATES, areas), n)
    dart &= np.uint64(2**PLACE_BITS - 1)
    dart |= np.repeat(area << np.uint64(PLACE_BITS), n)
    np.minimum.at(lowest, cell, dart)


def signatures(owner: np.ndarray, element: np.ndarray, documents: int) -> np.ndarray:
    """The dart that wins each coordinate of each document, as 64-bit numbers; zeros for a document without elements.

    Each unit column of weight throws darts at ranks of a Poisson process that depends on the column alone, area by area, so
    documents that share a column share its darts. Each dart is hashed to a coordinate, where the dart of lowest rank stays. A
    document goes on to further areas until no coordinate is empty; darts beyond have higher ranks and can't win. Two documents
    agree on a coordinate with their weighted Jaccard similarity as probability. A dart is its area and 40 bits of its place there,
    all in integers, so every machine throws the same. Work is in proportion to elements plus darts, not to their product."""
    lowest = np.full(documents * COORDINATES, NONE, np.uint64)
    signature = lowest.reshape(documents, COORDINATES)
    weight = np.bincount(owner, minlength=documents)
    first = np.zeros(documents, np.int64)
    open_, darts = weight > 0, FIRST_DARTS
    while open_.any():
        areas = -(-darts // np.maximum(weight, 1))
        live = np.flatnonzero(open_[owner])
        part = np.cumsum(areas[owner[live]]) // AREAS_AT_ONCE
        for some in np.split(live, np.flatnonzero(np.diff(part)) + 1):
            _throw(lowest, owner[some], element[some], first[owner[some]], areas[owner[some]])
        first += areas
        open_ &= (signature == NONE).any(1)
        darts = MORE_DARTS
    signature[weight == 0] = 0
    return signature


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        for some in words.passes(texts, PASS_CHARS, PASS_DOCUMENTS):
            owner, element = elements([texts[i] for i in some])
            n = len(some)
            size = np.bincount(owner, minlength=n)
            cut = np.r_[0, np.cumsum(size)]
            content = np.array([words.xxhash.xxh64_intdigest(element[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)], np.uint64)
            bands = np.zeros((n, BANDS), np.uint64)
            whole = signatures(owner, element, n)
            signed = whole[:, : BANDS * BAND_ROWS].reshape(n, BANDS, BAND_ROWS)
            sketch = np.zeros((n, COORDINATES // 16), np.uint64)
            for k in range(16):
                sketch = sketch << np.uint64(4) | whole[:, k::16] & np.uint64(15)
            for k in range(BAND_ROWS):
                bands = bands * np.uint64(0x9E3779B97F4A7C15) + signed[:, :, k]
            bands = words.mix(bands + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)).astype(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.astype(np.int64).ravel())) for x in (bands, sketch)]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(some.start, n), pa.array(content.astype(np.int64)), pa.array(size), *lists], names=["id", "node", "size", "bands", "sketch"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, elements): a document's elements, sorted."""
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        for some in words.passes(texts, PASS_CHARS, PASS_DOCUMENTS):
            owner, element = elements([texts[i] for i in some])
            cut = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(some)))]
            rows = [element[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            node = np.array([words.xxhash.xxh64_intdigest(x.tobytes()) for x in rows], np.uint64).astype(np.int64)
            packed = [np.sort(x).tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(packed, pa.binary())], names=["node", "elements"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 64):
        pairs = zip(batch.column("mine").to_pylist(), batch.column("theirs").to_pylist(), strict=True)
        keep = []
        for a, b in pairs:
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            if min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
                keep.append(False)
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(both >= THRESHOLD * (len(a) + len(b) - both))
        kept = batch.select(["low", "high"]).filter(pa.array(keep, pa.bool_()))
        yield kept


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (low, high) of nodes whose similarity reaches the threshold, by their elements.

    Only documents that stand for a node in some pair are read again and shuffled, told by a Bloom filter on their id. Where
    a low node has many partners, it is copied once for every MEMBERS_PER_COPY of them, so no task gets all."""
    wanted = pairs.select(F.col("low").alias("node")).union(pairs.select(F.col("high").alias("node"))).distinct()
    ids = written(wanted.join(nodes.select("node", "id_hash"), "node"), "wanted")
    n = ids.count()
    blocks = bloom_blocks(n, 16)
    chosen = bloom_probe(docs.withColumn("id_hash", F.xxhash64("id")), "id_hash", written(bloom_filter(ids, "id_hash", blocks, 2), "wanted-ids"), blocks, 2, "wanted")
    packed = chosen.where("wanted").select("text").mapInArrow(_pack, "node long, elements binary")
    packed = written(packed.join(ids.select("node"), "node", "left_semi").groupBy("node").agg(F.first("elements").alias("elements")), "elements")

    partners = pairs.groupBy("low").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / MEMBERS_PER_COPY).cast("int").alias("copies"))
    partners = written(partners, "partners")
    dealt = pairs.join(partners, "low").withColumn("copy", F.pmod(F.xxhash64("high"), F.col("copies")).cast("int"))
    leaders = packed.join(partners, packed["node"] == partners["low"]).select("low", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.col("elements").alias("mine"))
    both = dealt.select("low", "high", "copy").join(packed.select(F.col("node").alias("high"), F.col("elements").alias("theirs")), "high").join(leaders, ["low", "copy"])
    return both.select("low", "high", "mine", "theirs").mapInArrow(_similar, "low long, high long")


def _unlike(a: str, b: str):
    """In how many of their four-bit parts two sketches differ."""
    unlike = F.lit(0)
    for k in range(COORDINATES // 16):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        unlike += F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return unlike


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, root) that point up in some order, or to themselves: pointers are jumped until none moves."""
    while True:
        hops = written(parents, "parents")
        up = hops.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("next"))
        steps = written(hops.where("node <> root").select("root").distinct().join(up, "root"), "steps")
        if steps.isEmpty():
            return hops
        parents = _moved(hops, steps)


def _moved(labels: DataFrame, steps: DataFrame) -> DataFrame:
    """labels with each root that steps (root, next) have replaced. A root of very many nodes is split by Spark as the join runs."""
    return labels.join(steps, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, root): labels, all at their roots, with the roots that links (low, high) connect as one.

    Smallest labels travel along the links between roots, and pointers are jumped after each step, until nothing changes."""
    links = written(links, "more-links")
    while True:
        across = links.join(labels.select(F.col("node").alias("low"), F.col("root").alias("a")), "low").join(labels.select(F.col("node").alias("high"), F.col("root").alias("b")), "high")
        across = written(across.where("a <> b").select(F.least("a", "b").alias("small"), F.greatest("a", "b").alias("large")).distinct(), "across")
        if across.isEmpty():
            return labels
        # a root that hangs below several gets one of them now; the others follow in the next rounds
        moves = across.groupBy("large").agg(F.min("small").alias("small"))
        touched = moves.select(F.col("large").alias("node"), F.col("small").alias("root")).unionByName(moves.select(F.col("small").alias("node"), F.col("small").alias("root")).distinct().join(moves.select(F.col("large").alias("node")), "node", "left_anti"))
        merged = _roots(touched).where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = written(_moved(labels, merged), "labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, class_id, class_size, kept) for each row: its near-duplicate class, named by the smallest id in it.

    Two texts are linked if the weighted Jaccard similarity of their five-word shingles, weighted by count, is 0.8 or more;
    classes are what links connect. Equal shingle counts make one node, so copies are never paired. Nodes that share a band
    and have like sketches are candidates. First each is held against the hubs of its buckets, the nodes that share most, and the
    likest is verified; that settles most members of large classes. Then, where a bucket still holds several classes, each
    pair across them is a candidate; the sketches are compared within that join, so pairs that aren't alike are never rows.
    Candidates are verified on all their elements, 64-bit hashes. Rows without words (null, empty)
    are each a class of their own; rows that repeat an id or a text share the class. kept is true for the rows whose id is
    class_id; null ids count as larger than all others, and a row alone is kept in any case. An empty table gives none.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    signed = written(docs.mapInArrow(_sign, f"id {id_type}, node long, size long, bands array<long>, sketch array<long>"), "signatures")
    rows = signed.where("size > 0")
    nodes = rows.groupBy("node").agg(F.min(F.struct(F.xxhash64("id").alias("id_hash"), "bands", "sketch")).alias("one"), F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    nodes = written(nodes.select("node", "n", "first_id", "one.id_hash", "one.bands", "one.sketch"), "nodes")
    sketches = nodes.select("node", "sketch")
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    shared = written(members.join(buckets, "bucket"), "shared")

    hubs = shared.join(shared.groupBy("node").agg(F.sum("n").alias("degree")), "node").groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = written(hubs.select("bucket", F.col("hub.node").alias("low"), "n"), "hubs")
    spokes = shared.select("node", "bucket").join(hubs, "bucket").where("node <> low").select(F.col("node").alias("high"), "low").distinct()
    spokes = spokes.join(sketches.toDF("high", "mine"), "high").join(sketches.toDF("low", "theirs"), "low").select("low", "high", _unlike("mine", "theirs").alias("unlike")).where(F.col("unlike") <= MAX_UNLIKE)
    stars = written(spokes.groupBy("high").agg(F.min_by("low", F.struct("unlike", "low")).alias("low")), "stars")
    links = written(_verified(stars, nodes, docs), "links")
    labels = nodes.join(links.withColumnRenamed("high", "node"), "node", "left").select("node", F.coalesce("low", "node").alias("root"))
    labels = _roots(labels)

    within = written(shared.select("node", "bucket").join(labels, "node"), "within")
    parts = within.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"))
    open_ = written(within.join(parts.where("classes > 1").drop("n"), "bucket").join(nodes.select("node", "sketch", "bands"), "node"), "open")
    left = open_.where("root <> main").select("bucket", "main", F.col("node").alias("x"), F.col("root").alias("a"), F.col("sketch").alias("mine"), F.col("bands").alias("my_bands"))
    right = open_.select("bucket", F.col("node").alias("y"), F.col("root").alias("b"), F.col("sketch").alias("theirs"), F.col("bands").alias("their_bands"))
    first = F.get(F.array_intersect("my_bands", "their_bands"), F.lit(0))  # a pair is a row of the first bucket it shares alone
    pairs = left.join(right, "bucket").where((F.col("a") != F.col("b")) & ((F.col("b") == F.col("main")) | (F.col("x") < F.col("y"))) & (_unlike("mine", "theirs") <= MAX_UNLIKE) & (first == F.col("bucket")))
    pairs = pairs.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high"))
    tried = stars.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
    pairs = written(pairs.join(tried, ["low", "high"], "left_anti"), "pairs")
    labels = components(_verified(pairs, nodes, docs), labels)

    named = nodes.join(labels, "node")
    classes = named.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"))
    # by node: a third of all rows may be copies, but they are one node each here
    of_node = written(named.select("node", "root", "n").join(classes, "root"), "of-node")
    found = join_groups(rows.select("id", "node"), of_node.select("node", "class_id", "class_size", F.col("n").alias("copies")), "node", "copies", signed.count())
    found = found.select("id", "class_id", "class_size", F.coalesce(F.col("id") == F.col("class_id"), F.col("class_size") == 1).alias("kept"))
    alone = signed.where("size = 0").select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return found.unionByName(alone).withColumnRenamed("id", id_col)
