"""Passages of transcripts: humour scores, notes held against nearby chunks. Deduplication is in greedy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.functions import text as T


@dataclass(frozen=True)
class Markers:
    explicit: Sequence[str] = ()
    absurd: Sequence[str] = ()
    market: Sequence[str] = ()
    back: Sequence[str] = ()
    strong: Sequence[str] = ()


def _present(text: Column, words: Sequence[str]) -> Column:
    return sum((F.when(F.contains(text, F.lit(w)), 1).otherwise(0) for w in words), F.lit(0))


def humor_score(text: Column, markers: Markers, size: Column) -> Column:
    """Points for markers that are there, each once; size is that of the plain text."""
    explicit, strong = _present(text, markers.explicit), _present(text, markers.strong)
    some = lambda c: F.when(c > 0, 1).otherwise(0)
    return (
        F.least(F.lit(5), 4 * explicit)
        + F.least(F.lit(5), 2 * strong)
        + F.when((explicit > 0) | (strong > 0), F.least(F.lit(2), _present(text, markers.absurd))).otherwise(0)
        + 2 * some(strong) * some(_present(text, markers.market))
        + some(explicit) * some(_present(text, markers.back))
        + F.when(size.between(80, 1400), 1).otherwise(0)
    )


def first_class(text: Column, rules: Mapping[str, str], otherwise: str) -> Column:
    """The name of the first pattern that the text has."""
    found = F.lit(otherwise)
    for name, pattern in reversed(list(rules.items())):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def band_join(notes: DataFrame, chunks: DataFrame, on: str, before: int = 120, after: int = 150) -> DataFrame:
    """notes (on, note, at) with the chunks (on, chunk, seconds) from before seconds ahead of them to after behind; delta is chunk - note.

    Time is cut into spans as long as the band, and a note is joined with the two or three spans its band touches: an equi-join
    whose keys stay small however many chunks a day has."""
    span = before + after
    touched = F.sequence(F.floor((F.col("at") - before) / span), F.floor((F.col("at") + after) / span))
    left = notes.withColumn("span__", F.explode(touched))
    right = chunks.withColumn("span__", F.floor(F.col("seconds") / span))
    delta = F.col("seconds") - F.col("at")
    return left.join(right, [on, "span__"]).withColumn("delta", delta).where(F.col("delta").between(-before, after)).drop("span__")


def nearest_chunk(notes: DataFrame, chunks: DataFrame, on: str, note: str, chunk: str, within: int = 180) -> DataFrame:
    """The chunk nearest to each note, the earlier of two, at most within seconds away."""
    near = band_join(notes, chunks, on, within, within)
    best = near.groupBy(on, note).agg(F.min_by(F.struct(F.col(chunk), F.col("delta")), F.struct(F.abs("delta"), F.col("seconds"), F.col(chunk))).alias("b__"))
    return best.select(on, note, f"b__.{chunk}", "b__.delta")


def uncovered(chunks: DataFrame, notes: DataFrame, on: str, chunk: str, before: int = 130, after: int = 160) -> DataFrame:
    """Chunks that lie in no note's band."""
    hit = band_join(notes, chunks, on, before, after).select(on, chunk).distinct()
    return chunks.join(hit, [on, chunk], "left_anti")


def payload(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matches (keys, seconds, timestamp, text, similarity, score) of a note as one row."""
    return matches.groupBy(*keys).agg(
        F.min_by("timestamp", "seconds").alias("start_timestamp"),
        F.max_by("timestamp", "seconds").alias("end_timestamp"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seconds", "timestamp", "text"))), lambda m: F.concat(F.lit("["), m["timestamp"], F.lit("] "), m["text"])), "\n").alias("text"),
        F.count(F.lit(1)).alias("matched_chunk_count"),
        F.bround(F.max("similarity"), 4).alias("match_similarity_max"),
        F.max("score").alias("humor_score_max"),
    )


def chunks_of(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ord, timestamp, heading, body): a transcript cut at its `# mm:ss` headings; what stands before the first is left out."""
    mark = r"(?m)^#+\s*(?=\d{1,3}:\d{2}\b)"
    cut = docs.select(key, F.posexplode(F.slice(F.split(F.col(text), mark), 2, 1 << 20)).alias("ord", "part"))
    head = F.substring_index("part", "\n", 1)
    return cut.select(key, "ord", F.regexp_extract(head, r"^(\d{1,3}:\d{2})", 1).alias("timestamp"), T.strip(F.regexp_replace(head, r"^\d{1,3}:\d{2}\s*", "")).alias("heading"), T.strip(F.substring(F.col("part"), F.length(head) + 1, F.length("part"))).alias("body"))


def signal(text: Column, markers: Markers, pattern: str) -> Column:
    """Whether a passage has an explicit or a strong marker, or else the pattern, which stays within a line."""
    return (_present(text, markers.explicit) > 0) | (_present(text, markers.strong) > 0) | text.rlike(pattern)


def attached(notes: DataFrame, chunks: DataFrame, on: str, note: str, chunk: str) -> DataFrame:
    """(on, note, chunk, similarity, score): the chunks that belong to each note (on, note, at, grams), of chunks (on, chunk, seconds, grams, score, signal).

    In a note's band it is those like it, and those close by that are jokes by their own signs. Only a note that gets none there may have the
    nearest chunk, the earlier of two, within three minutes, and under stricter terms."""
    sides = notes.select(on, note, "at"), chunks.select(on, chunk, "seconds")
    told = chunks.select(on, chunk, F.col("grams").alias("theirs__"), "score", "signal")

    def judged(pairs: DataFrame) -> DataFrame:
        rows = pairs.join(notes.select(on, note, F.col("grams").alias("mine__")), [on, note]).join(told, [on, chunk])
        return rows.withColumn("similarity", T.jaccard(F.col("mine__"), F.col("theirs__"))).drop("mine__", "theirs__")

    near = judged(band_join(*sides, on).select(on, note, chunk, "delta"))
    near = near.where((F.col("similarity") >= 0.035) | ((F.abs("delta") <= 45) & (F.col("score") >= 5) & F.col("signal")))
    alone = notes.join(near.select(on, note).distinct(), [on, note], "left_anti")
    next_ = judged(nearest_chunk(alone.select(on, note, "at"), sides[1], on, note, chunk))
    next_ = next_.where((F.col("similarity") >= 0.04) | ((F.col("score") >= 6) & F.col("signal")))
    return near.select(on, note, chunk, "similarity", "score").unionByName(next_.select(on, note, chunk, "similarity", "score"))


def candidates(notes: DataFrame, chunks: DataFrame, on: str, note: str, chunk: str, least: int = 5) -> DataFrame:
    """(on, id, seconds, kinds, matched_chunk_count, match_similarity_max, humor_score_max, confidence): each note, with what is attached to it, and each
    chunk outside of all notes' bands that is a joke by its own signs."""
    sums = attached(notes, chunks, on, note, chunk).groupBy(on, note).agg(F.count(F.lit(1)).alias("matched_chunk_count"), F.bround(F.max("similarity"), 4).alias("match_similarity_max"), F.max("score").alias("humor_score_max"))
    labelled = notes.join(sums, [on, note], "left").select(on, F.col(note).alias("id"), F.col("at").alias("seconds"), F.when(F.col("matched_chunk_count").isNull(), "note").otherwise("note+transcript").alias("kinds"), "matched_chunk_count", "match_similarity_max", "humor_score_max", F.lit("high").alias("confidence"))
    funny = chunks.where((F.col("score") >= least) & F.col("signal"))
    loose = uncovered(funny, notes.select(on, note, "at"), on, chunk)
    confidence = F.when(F.col("score") >= least + 2, "medium").otherwise("low")
    found = loose.select(on, F.col(chunk).alias("id"), "seconds", F.lit("transcript").alias("kinds"), F.lit(1).cast("long").alias("matched_chunk_count"), F.lit(None).cast("double").alias("match_similarity_max"), F.col("score").alias("humor_score_max"), confidence.alias("confidence"))
    return labelled.unionByName(found)
