"""Corpus memories kept current by differences: what a document adds is kept, so that it can be taken away again.

A contribution is a row (doc, part, k1, k2, n): a document's hits below one heading of the memory. A memory is their sums,
(part, k1, k2, docs, hits), where docs is exact, as each document counts once a heading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("part", "k1", "k2")


def contributions(hits: DataFrame, doc: str, parts: Mapping[str, tuple[Column, Column]], n: str = "n") -> DataFrame:
    """(doc, part, k1, k2, n) from hits, for parts: the name of each part with its two keys, columns of hits. One scan and one grouping serve
    all parts; rows whose first key is null are no part's."""
    headings = F.array(*[F.struct(F.lit(name).alias("part"), k1.cast("string").alias("k1"), F.coalesce(k2.cast("string"), F.lit("")).alias("k2")) for name, (k1, k2) in parts.items()])
    flat = hits.select(F.col(doc).alias("doc"), F.explode(headings).alias("h__"), F.col(n).cast("long").alias("n")).select("doc", "h__.*", "n")
    return flat.where("k1 is not null").groupBy("doc", *KEYS).agg(F.sum("n").alias("n"))


def memory(kept: DataFrame) -> DataFrame:
    """The memory of all contributions, built anew."""
    return kept.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("hits"))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """(part, k1, k2, docs, hits), signed: old contributions taken away, new ones added. Headings that stay as they are have no row."""
    signed = old.select(*KEYS, F.lit(-1).cast("long").alias("docs"), F.negate("n").alias("hits")).unionByName(new.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.col("n").alias("hits")))
    return signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits")).where("docs <> 0 or hits <> 0")


def applied(current: DataFrame, delta: DataFrame) -> DataFrame:
    """The memory with a difference added; headings without a document go. The memory is small beside the corpus: it is grouped, texts aren't read."""
    both = current.select(*KEYS, "docs", "hits").unionByName(delta.select(*KEYS, "docs", "hits"))
    return both.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits")).where("docs > 0")


def updated(current: DataFrame, kept: DataFrame, changes: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(memory, contributions) after changes (doc, change), from those before and the fresh contributions of the added and changed documents.

    Only contributions of documents that changes name take part: those of changed and removed ones are taken away, fresh ones added. A change
    that is applied twice takes away what it has added, so the outcome is the same."""
    named = changes.select("doc").distinct()
    old = kept.join(named, "doc", "left_semi")
    stays = kept.join(named, "doc", "left_anti")
    come = fresh.join(changes.where("change <> 'removed'").select("doc").distinct(), "doc", "left_semi")
    return applied(current, difference(old, come)), stays.unionByName(come)


def section(current: DataFrame, part: str, k1: str, k2: str | None, docs: str, hits: str, every: Sequence[str] | None = None) -> DataFrame:
    """One part as a table of its own, with its columns named; every: first keys that get a row of zeros if nothing has them."""
    rows = current.where(F.col("part") == part)
    keys = [F.col("k1").alias(k1)] + ([F.col("k2").alias(k2)] if k2 else [])
    found = rows.select(*keys, F.col("docs").alias(docs), F.col("hits").alias(hits))
    if every is None:
        return found
    return rows.sparkSession.createDataFrame([(t,) for t in every], f"{k1} string").join(found, k1, "left").fillna(0, [docs, hits])
