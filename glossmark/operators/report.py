"""Corpus reports and memories: every section from one scan of the documents and one grouping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmark.functions import text as T
from glossmark.operators.dictionary import Dictionary

#: The kind of the row that each document has, hits or none.
ALL = "all"


def document_hits(docs: DataFrame, dictionaries: Mapping[str, Dictionary], keep: Sequence[str], text: str = "text") -> DataFrame:
    """(keep, kind, name, hits): for each document a row of kind `all` with the hits of all dictionaries, and one for each entry of a
    dictionary that has hits in it.

    docs has a row a document. The text is read once where it lies, and hits are summed within the row, so nothing is shuffled
    and a document is never counted twice. A null text has no hits."""
    hits = lambda words: reduce(add, [T.count_literal(F.col(text), w) for w in words])
    row = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.coalesce(n, F.lit(0).cast("long")).alias("hits"))
    counted = F.array(*[row(kind, name, hits(words)) for kind, entries in dictionaries.items() for name, words in entries.items()])
    found = docs.select(*keep, counted.alias("c__"))
    every = F.aggregate("c__", F.lit(0).cast("long"), lambda a, x: a + x["hits"])
    rows = F.concat(F.array(row(ALL, "", every)), F.filter("c__", lambda x: x["hits"] > 0))
    return found.select(*keep, F.explode(rows).alias("h__")).select(*keep, "h__.*")


def sections(hits: DataFrame, parts: Mapping[str, str], day: str = "day") -> DataFrame:
    """(section, name, part, episodes, hits, first_day, last_day, place): a section for each kind, and one for each kind and part (`theme_year`).

    hits is document_hits with day and the columns that parts names; a part that is null is `unknown`. place is by hits, most first, then name
    and part. The sections are grouping sets of one shuffle, before which each task has a row a group; what is left, and so what
    the window over places sees, is as many rows as entries times values of the parts, not documents."""
    rows = hits.select("kind", "name", "hits", F.col(day).alias("day__"), *[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(f"{p}__") for p, c in parts.items()])
    by = ["kind", "name"]
    names = [f"{p}__" for p in parts]
    grouped = rows.groupingSets([by, *[[*by, n] for n in names]], *by, *names).agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("hits").alias("hits"), F.min("day__").alias("first_day"), F.max("day__").alias("last_day"),
        *[F.grouping(n).alias(f"g_{n}") for n in names],
    )
    section = F.concat_ws("_", "kind", *[F.when(F.col(f"g_{p}__") == 0, F.lit(p)) for p in parts])
    found = grouped.select(section.alias("section"), "name", F.coalesce(*names, F.lit("")).alias("part"), "episodes", "hits", "first_day", "last_day")
    return found.withColumn("place", F.row_number().over(W.partitionBy("section").orderBy(F.desc("hits"), "name", "part")))


def memory(found: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(kind, name, memory): sections as one JSON document for each entry: its counts, first and last day, and by each part its values' counts in order."""
    pieces = F.split("section", "_", 2)
    rows = found.withColumn("kind", pieces[0]).withColumn("of__", F.coalesce(F.get(pieces, F.lit(1)), F.lit("")))
    whole = F.max_by(F.struct("episodes", "hits", "first_day", "last_day"), F.col("of__") == "")
    listed = lambda p: F.array_sort(F.array_compact(F.collect_list(F.when(F.col("of__") == p, F.struct("part", "episodes", "hits"))))).alias(p)
    each = rows.groupBy("kind", "name").agg(whole.alias("w__"), *[listed(p) for p in parts])
    return each.select("kind", "name", F.to_json(F.struct("w__.*", *parts)).alias("memory"))


def markdown(found: DataFrame, headings: Mapping[str, str], limit: int) -> DataFrame:
    """(ord, value): a Markdown table for each section of headings, in their order, with the first rows by place. A section without rows is its heading
    and an empty table."""
    spark = found.sparkSession
    titles = spark.createDataFrame([(i, s, h) for i, (s, h) in enumerate(headings.items())], "ord int, section string, heading string")
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, ("name", "part", "episodes", "hits"))), F.lit(" |"))
    top = found.where((F.col("place") <= limit) & F.col("section").isin(*headings)).select("section", F.struct("place", line.alias("line")).alias("l__"))
    lines = top.groupBy("section").agg(F.array_sort(F.collect_list("l__")).alias("l__"))
    head = F.concat(F.lit("## "), F.col("heading"), F.lit("\n\n| name | part | episodes | hits |\n|---|---|---|---|\n"))
    body: Column = F.concat(head, F.array_join(F.transform(F.coalesce("l__", F.array().cast(top.groupBy().agg(F.collect_list("l__")).schema[0].dataType)), lambda x: F.concat(x["line"], F.lit("\n"))), ""))
    return titles.join(lines, "section", "left").select("ord", body.alias("value"))
