"""Keyword dictionaries over documents: counts, rollups, rankings. Dictionaries are rows (dict, ord, keyword_ord, keyword)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmark.functions import text as T

Dictionary = Mapping[str, Sequence[str]]


def rows(spark: SparkSession, dictionary: Dictionary) -> DataFrame:
    """(theme, theme_ord, keyword, keyword_ord) of a dictionary."""
    flat = [(t, i, k, j) for i, (t, words) in enumerate(dictionary.items()) for j, k in enumerate(words)]
    return spark.createDataFrame(flat, "theme string, theme_ord int, keyword string, keyword_ord int")


def keyword_counts(docs: DataFrame, dictionary: Dictionary, text: str = "text", any_case: bool = False) -> DataFrame:
    """docs with theme, theme_ord, keyword, keyword_ord and n: a row for each keyword of a theme that occurs, zeros dropped.

    A fixed dictionary becomes literals of one expression, so the text is scanned once where it lies: no join, and no copy of
    the text for each keyword."""
    count = T.count_literal_any_case if any_case else T.count_literal
    hits = [F.struct(F.lit(t).alias("theme"), F.lit(i).alias("theme_ord"), F.lit(k).alias("keyword"), F.lit(j).alias("keyword_ord"), count(F.col(text), k).alias("n")) for i, (t, words) in enumerate(dictionary.items()) for j, k in enumerate(words)]
    found = docs.select(*[c for c in docs.columns if c != text], F.explode(F.filter(F.array(*hits), lambda h: h["n"] > 0)).alias("hit__"))
    return found.select(*[c for c in docs.columns if c != text], "hit__.*")


def theme_hits(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per document and theme: hit_count, and the counts by keyword."""
    by = [*keys, "theme", "theme_ord"]
    return counts.groupBy(*by).agg(F.sum("n").alias("hit_count"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("keyword", "n")))).alias("keyword_counts"))


def rollup(counts: DataFrame, key: str, themes: Dictionary | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Per theme: documents with a hit, and hits. With themes given, those without hits are rows of zeros."""
    found = counts.groupBy("theme").agg(F.count_distinct(key).alias("episode_count"), F.sum("n").alias("hit_count"))
    if themes is None:
        return found
    every = spark.createDataFrame([(t,) for t in themes], "theme string")
    return every.join(found, "theme", "left").fillna(0, ["episode_count", "hit_count"])


def most_common(counts: DataFrame, key_ord: str) -> DataFrame:
    """(theme, keyword, n, place): keywords of a theme by hits; ties in the order they were first seen, by document then keyword."""
    totals = counts.groupBy("theme", "keyword").agg(F.sum("n").alias("n"), F.min(F.struct(key_ord, "keyword_ord")).alias("first__"))
    order = W.partitionBy("theme").orderBy(F.desc("n"), "first__")
    return totals.select("theme", "keyword", "n", F.row_number().over(order).alias("place"))


def top_documents(hits: DataFrame, by: Sequence[Column], k: int, group: str = "theme") -> DataFrame:
    """The first k documents of each group in the order given, with their place; Spark prunes before the shuffle."""
    order = W.partitionBy(group).orderBy(*by)
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def score_query(query: str, dictionary: Dictionary, labels: Mapping[str, str], per_keyword: int) -> list[tuple[str, int, int]]:
    """(theme, ord, score) of a question: so much for each keyword in it, 2 for each piece of the label."""
    lower = query.lower()
    pieces = lambda label: [p for p in label.replace("、", " ").split() if p]
    return [(t, i, per_keyword * sum(k.lower() in lower for k in words) + 2 * sum(p in query for p in pieces(labels.get(t, "")))) for i, (t, words) in enumerate(dictionary.items())]


def best_themes(scored: Sequence[tuple[str, int, int]], k: int) -> list[str]:
    """The k best themes of score_query's rows, best first; none if none scores, and then choose_themes falls back on the corpus."""
    return [t for t, i, s in sorted(scored, key=lambda r: (-r[2], r[1])) if s > 0][:k]


def choose_themes(rolled: DataFrame, scored: DataFrame, k: int, fallback: Sequence[str]) -> DataFrame:
    """The k best themes of a question; if none scores, those of fallback, by hits."""
    both = scored.join(rolled, "theme", "left")
    none = scored.agg((F.max("score") <= 0).alias("none__"))
    rank = F.when(F.col("none__"), F.when(F.col("theme").isin(*fallback), F.coalesce("hit_count", F.lit(0)))).otherwise(F.when(F.col("score") > 0, F.col("score")))
    ranked = both.crossJoin(F.broadcast(none)).withColumn("rank_score", rank).where("rank_score is not null").drop("none__")
    return ranked.orderBy(F.desc("rank_score"), "theme_ord").limit(k)


def evidence_scores(counts: DataFrame, keys: Sequence[str], chosen: DataFrame, query: str) -> DataFrame:
    """Per document: hits of the chosen themes, and five for each hit of a keyword that the question has."""
    asked = F.instr(F.lit(query.lower()), F.lower("keyword")) > 0
    weight = F.when(asked, 6).otherwise(1)
    return counts.join(chosen.select("theme"), "theme", "left_semi").groupBy(*keys).agg(F.sum(F.col("n") * weight).alias("score"))


def asset_rollup(hits: DataFrame) -> DataFrame:
    """hits (ord, source, symbol, name, kind, alias, n): per asset, named by its symbol or else its name: documents, hits, what its last row says,
    and its aliases with their hits, most first, then by name."""
    key = F.coalesce(F.nullif("symbol", F.lit("")), F.nullif("name", F.lit("")))
    last = F.max_by(F.struct("name", "symbol", "kind"), F.struct("ord", "name", "kind")).alias("last__")
    named = hits.withColumn("asset", key).where("asset is not null")
    found = named.groupBy("asset").agg(F.count_distinct("source").alias("episode_count"), F.sum("n").alias("hit_count"), last)
    sums = named.groupBy("asset", "alias").agg(F.sum("n").alias("n")).groupBy("asset").agg(F.array_sort(F.collect_list(F.struct(F.negate("n").alias("less"), "alias"))).alias("l__"))
    aliases = F.transform("l__", lambda x: F.struct(x["alias"].alias("alias"), (-x["less"]).alias("n")))
    return found.join(sums, "asset").select("asset", "episode_count", "hit_count", "last__.*", aliases.alias("aliases"))


def first_snippets(snippets: DataFrame, chosen: DataFrame, key: str, k: int) -> DataFrame:
    """The first k of each record's snippets (key, theme, place, others) over the chosen themes (theme, theme_rank): theme by theme in rank,
    and within one in their stored order. The window drops all but k of a record in each task before the shuffle."""
    rows = snippets.join(chosen.select("theme", "theme_rank"), "theme")
    order = W.partitionBy(key).orderBy("theme_rank", "place")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
