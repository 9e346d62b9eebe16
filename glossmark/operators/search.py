"""Search over a corpus in three dialects: by place, and by score newest or oldest first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.functions import text as T


def dated_between(date: Column, since: str | None = None, until: str | None = None, on: str | None = None) -> Column:
    """On date strings; a missing one is '', which fails since and passes until."""
    date = F.coalesce(date, F.lit(""))
    tests = [date == on if on else None, date >= since if since else None, date <= until if until else None]
    found = F.lit(True)
    for t in tests:
        found = found & t if t is not None else found
    return found


def relevance(normal: Column, needles: Sequence[str]) -> Column:
    """Occurrences times length, over all terms; empty terms count nothing."""
    total = F.lit(0).cast("long")
    for n in needles:
        total = total + T.count_literal(normal, n) * max(1, len(n))
    return total


def scored(docs: DataFrame, terms: Sequence[str], limit: int = 20, oldest_first: bool = False, width: int = 220, text: str = "text", date: str = "date", ord_: str = "doc_id") -> DataFrame:
    """docs' other columns with score and snippet, of those that score: by date, then score, then ord. The text is dropped before the sort,
    and the limit makes the sort a top-k of each task."""
    import unicodedata

    needles = [unicodedata.normalize("NFKC", t).lower() for t in terms]
    keep = [c for c in docs.columns if c != text]
    normal = docs.withColumn("normal__", T.nfkc_lower(F.col(text)))
    hits = normal.withColumn("score", relevance(F.col("normal__"), needles)).where("score > 0")
    rows = hits.select(*keep, "score", T.first_hit_snippet(F.col(text), F.col("normal__"), needles, width).alias("snippet"))
    way = F.asc if oldest_first else F.desc
    return rows.orderBy(way(F.coalesce(date, F.lit(""))), way("score"), F.asc(ord_)).limit(limit)


def positional(docs: DataFrame, queries: Sequence[str], limit: int = 50, context: int = 90, newest_first: bool = True, regex: bool = False, case_sensitive: bool = False, only: Sequence[int] | None = None, text: str = "text", number: str = "doc_id") -> DataFrame:
    """(number, query, query_ord, start, match, snippet): matches by document, query and place; of the documents numbered in only, if it is given.

    Documents that can't be among the first limit are cut early: matches are counted where the text lies, and only as many
    documents as the limit needs have theirs written out."""
    patterns = [("" if case_sensitive else "(?iu)") + (q if regex else T.literal(q)) for q in queries]
    any_hit = F.col(text).rlike("|".join(f"(?:{p})" for p in patterns))
    way = F.desc if newest_first else F.asc
    docs = docs.where(F.col(number).isin(*only)) if only else docs
    first = docs.where(any_hit).select(number, text).orderBy(way(number)).limit(limit)
    hits = None
    for i, (q, p) in enumerate(zip(queries, patterns, strict=True)):
        found = first.select(number, text, F.lit(q).alias("query"), F.lit(i).alias("query_ord"), F.explode(T.matches(F.col(text), p)).alias("m"))
        hits = found if hits is None else hits.unionByName(found)
    rows = hits.select(number, "query", "query_ord", "m.start", "m.match", T.around(F.col(text), F.col("m.start"), F.length("m.match"), context).alias("snippet"))
    return rows.orderBy(way(number), "query_ord", "start").limit(limit)


def any_term(text: Column, terms: Sequence[str]) -> Column:
    """Whether the text has any of the terms, as they are."""
    found = F.lit(False)
    for t in terms:
        found = found | F.contains(text, F.lit(t))
    return found


def author_relevance(fields: dict[str, Column], terms: Sequence[str], weights: dict[str, int], dedicated: Column) -> tuple[Column, Column]:
    """(score, included) of a feed item: each term scores a field's weight where the field has it, 1 if none is given; 2 includes."""
    total = F.lit(0)
    for term in (t.strip().lower() for t in terms):
        for name, column in fields.items():
            if term:
                total = total + F.when(F.contains(F.lower(F.coalesce(column, F.lit(""))), F.lit(term)), weights.get(name, 1)).otherwise(0)
    return total, dedicated | (total >= 2)
