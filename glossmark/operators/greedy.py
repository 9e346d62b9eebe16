"""Greedy deduplication in order, of any number of rows a day: similar texts are found by an index, and the ordered choice is made in one stream."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from glossmark.checkpoints import settled
from glossmark.functions import text as T
from glossmark.operators.similar import contained_pairs, similar_pairs

#: What makes two passages the same: alike by so much wherever they stand; or near in time and a little alike, or of different kinds. Headings
#: that are both there must be alike, too. Fixed values.
ALIKE, NEAR_ALIKE, NEAR_SECONDS, HEADINGS_ALIKE = 0.55, 0.035, 130, 0.35
#: Where rows without a time, or at 0, stand.
LAST = 999_999


def grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2)) if len(text) > 3 else frozenset([text]) if text else frozenset()


def similarity(x: frozenset[str], y: frozenset[str]) -> float:
    return len(x & y) / len(x | y) if x and y else 0.0


@dataclass
class Cluster:
    """Passages taken as one: the first one's place and heading, all kinds, and the texts one after the other up to a limit."""

    number: int
    first: object
    text: str
    seconds: int | None
    heading: str
    kinds: set[str]
    kept: bool = False
    near: bool = False
    size: int = 1
    grams: frozenset[str] = field(default_factory=frozenset)

    def same(self, text: frozenset[str], seconds: int | None, heading: str, kind: str) -> bool:
        if self.heading and heading and self.heading != heading and similarity(grams(self.heading), grams(heading)) < HEADINGS_ALIKE:
            return False
        alike = similarity(self.grams, text)
        if self.seconds is not None and seconds is not None and abs(self.seconds - seconds) <= NEAR_SECONDS and (alike >= NEAR_ALIKE or self.kinds != {kind}):
            return True
        return alike >= ALIKE


class Day:
    """The ordered choice over one day's rows, which come by time. Clusters are held as long as a row can be near them in time, and beyond that
    only those with a text that the index found to be like another one."""

    def __init__(self, limit: int):
        self.limit, self.clusters = limit, 0
        self.near: deque[Cluster] = deque()
        self.at_zero: list[Cluster] = []
        self.by_node: dict[object, list[Cluster]] = {}
        self.by_first: dict[object, Cluster] = {}
        self.gone: list[Cluster] = []

    def place(self, row: dict) -> Cluster:
        seconds, heading, text = row["seconds"], row["heading"] or "", row["text"] or ""
        if seconds:
            while self.near and self.near[0].seconds < seconds - NEAR_SECONDS:
                old = self.near.popleft()
                old.near = False
                if not old.kept:
                    self.gone.append(old)
        around = list(self.near) if seconds else self.at_zero if seconds == 0 else []
        like = [c for n in (row["node"], *(row["far"] or ())) for c in self.by_node.get(n, ())]
        named = [self.by_first[i] for i in row["extra"] or () if i in self.by_first]
        own = grams(text)
        for cluster in sorted({c.number: c for c in (*around, *like, *named)}.values(), key=lambda c: c.number):
            if cluster.same(own, seconds, heading, row["kind"]):
                cluster.text = (cluster.text + text)[: self.limit]
                cluster.grams = grams(cluster.text)
                cluster.kinds.add(row["kind"])
                cluster.size += 1
                break
        else:
            cluster = Cluster(self.clusters, row["id"], text, seconds, heading, {row["kind"]}, grams=own)
            self.clusters += 1
            if seconds is not None:
                if abs(seconds) <= NEAR_SECONDS:
                    self.at_zero.append(cluster)
                    cluster.kept = True
                if seconds:
                    self.near.append(cluster)
                    cluster.near = True
            if row["target"]:
                self.by_first[row["id"]] = cluster
                cluster.kept = True
        if row["like"]:
            held = self.by_node.setdefault(row["node"], [])
            if cluster not in held:
                held.append(cluster)
            cluster.kept = True
        elif cluster.size == 1 and not cluster.near and not cluster.kept:
            self.gone.append(cluster)
        return cluster

    def ended(self) -> list[Cluster]:
        """Clusters of two rows or more that no row can join any more, once each."""
        out, self.gone = [c for c in self.gone if c.size > 1], []
        return out

    def rest(self) -> list[Cluster]:
        """The others, at the day's end."""
        held = {c.number: c for cs in ([*self.near], self.at_zero, [*self.by_first.values()], *self.by_node.values()) for c in cs}
        return self.ended() + [c for c in held.values() if c.size > 1]


def _chosen(rows: DataFrame, day: str, limit: int) -> DataFrame:
    """(day, id, cluster, text): each row's cluster, and, with a null id, the text of each cluster of several rows."""
    kinds = dict(rows.dtypes)
    schema = f"{day} {kinds[day]}, id {kinds['id']}, cluster {kinds['id']}, text string"
    types = [to_arrow_type(rows.schema[c].dataType) for c in (day, "id", "id")] + [pa.string()]
    names = [day, "id", "cluster", "text"]
    columns = [day, "id", "seconds", "heading", "kind", "text", "node", "far", "extra", "like", "target"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now = None, None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(types)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = []
                for row in batch.slice(at, 256).to_pylist():
                    if state is None or row[day] != now:
                        found += [(now, None, c.first, c.text) for c in (state.rest() if state else ())]
                        state, now = Day(limit), row[day]
                    found.append((now, row["id"], state.place(row).first, None))
                    found += [(now, None, c.first, c.text) for c in state.ended()]
                yield batch_of(found)
        if state:
            yield batch_of([(now, None, c.first, c.text) for c in state.rest()])

    return rows.repartition(day).sortWithinPartitions(day, "at", "id").select(*columns).mapInArrow(stream, schema)


def greedy_dedupe(rows: DataFrame, day: str = "day", limit: int = 2400) -> DataFrame:
    """rows (day, id, seconds, heading, kind, text) with cluster, the id of the cluster's first row, and cluster_size.

    Rows of a day are taken by time, those without one, or at 0, last, equal times by id; each joins the first cluster that is the same,
    whose text then grows by it, and so may attract what it would not have before. text is compared bare: see functions.text.bare.

    No pairs of all rows, and no day in memory: distinct texts that are alike are found by a join on their rarest trigrams (in a day of few texts, of each pair); then one pass over each day's rows, in order,
    compares a row with clusters near it in time and with those that hold a text like its own. That a cluster's grown text can attract
    more than its texts do by themselves is made sure of afterwards: a join of grown texts with rows they mostly contain names what the
    pass didn't compare, and such days are passed again with these, until nothing is new. So the outcome is that of comparing every row
    with every cluster. Days and ids must not be null; an id comes once a day."""
    plain = rows.select(day, "id", F.col("seconds").cast("long").alias("seconds"), "heading", "kind", F.coalesce("text", F.lit("")).alias("text"))
    texts = settled(plain.groupBy(day, "text").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies__")))
    grams_of = lambda some: some.where("text <> ''").select(day, "node", T.trigrams(F.col("text")).alias("grams"))
    pairs = settled(similar_pairs(grams_of(texts), day, "node", "grams", ALIKE))
    both = pairs.select(day, F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(day, F.col("b").alias("node"), F.col("a").alias("other")))
    far = both.groupBy(day, "node").agg(F.collect_list("other").alias("far"))
    at = F.when(F.coalesce("seconds", F.lit(0)) == 0, LAST).otherwise(F.col("seconds"))
    known = texts.join(far, [day, "node"], "left")
    base = settled(plain.withColumn("at", at).join(known, [day, "text"]).withColumn("like", (F.col("copies__") > 1) | F.col("far").isNotNull()).drop("copies__"))

    def passed(part: DataFrame, extras: DataFrame | None) -> DataFrame:
        if extras is None:
            told = part.withColumns({"extra": F.array().cast(f"array<{dict(part.dtypes)['id']}>"), "target": F.lit(False)})
        else:
            named = extras.groupBy(day, "id").agg(F.collect_set("cluster").alias("extra"))
            targets = extras.select(day, F.col("cluster").alias("id"), F.lit(True).alias("target")).distinct()
            told = part.join(named, [day, "id"], "left").join(targets, [day, "id"], "left").fillna(False, ["target"])
        return _chosen(told, day, limit)

    found, extras = settled(passed(base, None)), None
    part = found  # the days passed last: others gave nothing new before, and are as they were
    while True:
        grown = part.where("id is null").select(day, "cluster", T.trigrams(F.col("text")).alias("grams"))
        near = texts.join(part.where("id is null").select(day).distinct(), day, "left_semi")
        hits = contained_pairs(grams_of(near), grown, day, "node", "cluster", "grams", ALIKE)
        first = base.select(day, F.col("id").alias("cluster"), F.struct("at", "id").alias("begun__"))
        mine = part.where("id is not null").select(day, "id", F.col("cluster").alias("mine__"))
        late = base.select(day, "node", "id", F.struct("at", "id").alias("place__")).join(hits, [day, "node"]).join(first, [day, "cluster"]).where("place__ > begun__")
        new = late.join(mine, [day, "id"]).where("mine__ <> cluster").select(day, "id", "cluster")
        if extras is not None:
            new = new.join(extras, [day, "id", "cluster"], "left_anti")
        new = settled(new)
        if new.isEmpty():
            break
        days = new.select(day).distinct()
        extras = new if extras is None else settled(extras.unionByName(new))
        part = settled(passed(base.join(days, day, "left_semi"), extras))
        found = settled(found.join(days, day, "left_anti").unionByName(part))
    placed = found.where("id is not null").select(day, "id", "cluster")
    return placed.join(placed.groupBy(day, "cluster").agg(F.count(F.lit(1)).cast("int").alias("cluster_size")), [day, "cluster"]).select(day, "id", "cluster", "cluster_size")
