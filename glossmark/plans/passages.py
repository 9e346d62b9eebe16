"""Queries over passages and notes: bands in time, humour, deduplication, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import text as T
from glossmark.functions import times
from glossmark.operators import greedy
from glossmark.operators import humor as H
from glossmark.operators import notes as N
from glossmark.plans.tables import table
from glossmark.registry import oracle_sql, register

_NOTES = "SELECT user_id, event_id AS note, epoch(ts)::BIGINT AS note_s FROM events WHERE event_type = 'purchase'"
_CHUNKS = "SELECT user_id, event_id AS chunk, epoch(ts)::BIGINT AS seconds FROM events WHERE event_type <> 'purchase'"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events").withColumn("t", F.unix_seconds(F.col("ts").cast("timestamp")))
    notes = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("note"), F.col("t").alias("at"))
    return notes, events.where("event_type <> 'purchase'").select("user_id", F.col("event_id").alias("chunk"), F.col("t").alias("seconds"))


@register("band_join", f"SELECT n.user_id, note, chunk, seconds - note_s AS delta FROM ({_NOTES.replace('epoch(ts)', 'floor(epoch(ts))')}) n JOIN ({_CHUNKS.replace('epoch(ts)', 'floor(epoch(ts))')}) c ON n.user_id = c.user_id AND seconds - note_s BETWEEN -12000 AND 15000")
def band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks in the band around each note. The events are sparse, so the band is a hundred times the usual one."""
    return H.band_join(*_sides(spark, sf_dir), "user_id", 12000, 15000).select("user_id", "note", "chunk", "delta")


@register(
    "nearest_chunk",
    f"SELECT n.user_id, note, chunk, seconds - note_s AS delta FROM ({_NOTES.replace('epoch(ts)', 'floor(epoch(ts))')}) n JOIN ({_CHUNKS.replace('epoch(ts)', 'floor(epoch(ts))')}) c ON n.user_id = c.user_id AND abs(seconds - note_s) <= 18000 QUALIFY row_number() OVER (PARTITION BY n.user_id, note ORDER BY abs(seconds - note_s), seconds, chunk) = 1",
)
def nearest_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.nearest_chunk(*_sides(spark, sf_dir), "user_id", "note", "chunk", 18000)


@register("uncovered_chunks", f"SELECT user_id, chunk, seconds FROM ({_CHUNKS.replace('epoch(ts)', 'floor(epoch(ts))')}) c WHERE NOT EXISTS (SELECT 1 FROM ({_NOTES.replace('epoch(ts)', 'floor(epoch(ts))')}) n WHERE n.user_id = c.user_id AND seconds - note_s BETWEEN -13000 AND 16000)")
def uncovered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes, chunks = _sides(spark, sf_dir)
    return H.uncovered(chunks, notes, "user_id", "chunk", 13000, 16000).select("user_id", "chunk", "seconds")


MARKERS = H.Markers(explicit=("joke", "que "), absurd=("ou ", "sch", "the "), market=("tion", "ung"), back=("is ", "est"), strong=("eau", "ing"))


def _has(words) -> str:
    return "(" + " + ".join(f"contains(text, '{w}')::INT" for w in words) + ")"


_SCORE = f"""least(5, 4 * {_has(MARKERS.explicit)}) + least(5, 2 * {_has(MARKERS.strong)}) + CASE WHEN {_has(MARKERS.explicit)} > 0 OR {_has(MARKERS.strong)} > 0 THEN least(2, {_has(MARKERS.absurd)}) ELSE 0 END
 + CASE WHEN {_has(MARKERS.strong)} > 0 AND {_has(MARKERS.market)} > 0 THEN 2 ELSE 0 END + CASE WHEN {_has(MARKERS.explicit)} > 0 AND {_has(MARKERS.back)} > 0 THEN 1 ELSE 0 END + CASE WHEN length(text) BETWEEN 80 AND 1400 THEN 1 ELSE 0 END"""


@register("humor_score", f"SELECT conv_id, turn, ({_SCORE})::INT AS score FROM conversations")
def humor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", H.humor_score(F.col("text"), MARKERS, F.length("text")).alias("score"))


_TYPES = {"pun": "eau.*que|\\?", "history": "sch", "analogy": "tion|ing ", "wordplay": "ou "}


@register(
    "humor_type",
    "SELECT conv_id, turn, CASE WHEN regexp_matches(text, 'eau.*que|\\?') THEN 'pun' WHEN regexp_matches(text, 'sch') THEN 'history' WHEN regexp_matches(text, 'tion|ing ') THEN 'analogy' WHEN regexp_matches(text, 'ou ') THEN 'wordplay' ELSE 'other' END AS kind, regexp_matches(text, 'la |der ') AS sensitive FROM conversations",
)
def humor_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", H.first_class(text, _TYPES, "other").alias("kind"), text.rlike("la |der ").alias("sensitive"))


@register(
    "humor_summary",
    f"SELECT role, count(*) AS rows_, count(*) FILTER (score >= 8) AS high, count(*) FILTER (score BETWEEN 4 AND 7) AS medium, max(score) AS top FROM (SELECT role, ({_SCORE})::INT AS score FROM conversations) GROUP BY role",
)
def humor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = H.humor_score(F.col("text"), MARKERS, F.length("text")).alias("score")
    rows = table(spark, sf_dir, "conversations").select("role", score)
    return rows.groupBy("role").agg(F.count(F.lit(1)).alias("rows_"), F.count_if(F.col("score") >= 8).alias("high"), F.count_if(F.col("score").between(4, 7)).alias("medium"), F.max("score").alias("top"))


@register(
    "conversation_payload",
    "SELECT conv_id, arg_min(role, turn) AS start_timestamp, arg_max(role, turn) AS end_timestamp, string_agg('[' || role || '] ' || text, chr(10) ORDER BY turn, role, text) AS text, count(*) AS matched_chunk_count, round_even(max(length(text) / 1000), 4) AS match_similarity_max, max(length(text)) AS humor_score_max FROM conversations GROUP BY conv_id",
)
def conversation_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that belong to a note as one row: first and last mark, text in order, maxima."""
    return _payload(spark, sf_dir, F.col("text"))


@register("conversation_payload_whole", oracle_sql()["conversation_payload"])
def conversation_payload_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that conversation_payload had while that one read beginnings."""
    return conversation_payload(spark, sf_dir)


def _payload(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seconds"), F.col("role").alias("timestamp"), text.alias("text"), (F.length("text") / 1000).alias("similarity"), F.length("text").cast("long").alias("score"))
    return H.payload(rows, ["conv_id"])


@register("greedy_dedupe")
def greedy_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation that repeat one another, taken in order."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("day"), F.col("turn").alias("id"), (F.col("turn") * 60).cast("long").alias("seconds"), F.lit("").alias("heading"), F.col("role").alias("kind"), T.bare(F.col("text")).alias("text"))
    return greedy.greedy_dedupe(rows)


_ALIASES = {"clk": "click", "buy": "purchase", "bought": "purchase"}


@register(
    "enum_normalize",
    "SELECT event_id, CASE WHEN trim(v) IN ('click', 'view', 'purchase') THEN trim(v) WHEN lower(trim(v)) IN ('click', 'view', 'purchase') THEN lower(trim(v)) WHEN lower(trim(v)) = 'clk' THEN 'click' WHEN lower(trim(v)) IN ('buy', 'bought') THEN 'purchase' ELSE 'other' END AS kind FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN upper(event_type) WHEN 1 THEN ' Buy ' WHEN 2 THEN 'clk' WHEN 3 THEN NULL WHEN 4 THEN event_type ELSE 'Bought' END AS v FROM events)".replace("trim(v) IN", "trim(coalesce(v, '')) IN"),
)
def enum_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 6
    value = F.when(k == 0, F.upper("event_type")).when(k == 1, " Buy ").when(k == 2, "clk").when(k == 4, F.col("event_type")).when(k == 5, "Bought")
    return table(spark, sf_dir, "events").select("event_id", N.enum_value(value, ("click", "view", "purchase"), _ALIASES, "other").alias("kind"))


@register("bool_coerce", "SELECT event_id, coalesce(lower(trim(v)) IN ('1', 'true', 'yes', 'y', '是', '對'), false) AS flag FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN ' Yes' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN NULL WHEN 4 THEN 'TRUE' WHEN 5 THEN '對' ELSE event_type END AS v FROM events)")
def bool_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 7
    value = F.when(k == 0, " Yes").when(k == 1, "no").when(k == 2, "1").when(k == 4, "TRUE").when(k == 5, "對").when(k == 6, F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", N.bool_value(value).alias("flag"))


_K = "CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS INT)"


@register(
    "note_validate",
    f"""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'missing field: event_type' ELSE concat_ws('; ', CASE WHEN k > 80 THEN 'k out of range' END, CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'event_type: unknown value' END,
 CASE WHEN NOT (value + k BETWEEN 95 AND 105) THEN 'percentages do not add up' END, CASE WHEN k % 2 = 1 THEN 'dangling: c' || k END) END AS errors FROM (SELECT *, {_K} AS k FROM events)""",
)
def note_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of each note, its properties read as JSON; a missing field ends the checks."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", k.alias("k"))
    kind = F.when(F.col("event_id") % 9 != 0, F.col("event_type"))
    loose = N.dangling(F.array(F.when(F.col("k") % 2 == 1, F.concat(F.lit("c"), F.col("k").cast("string")))), F.array(F.lit("d")))
    rules = [
        ("k out of range", F.col("k") > 80),
        ("event_type: unknown value", ~kind.isin("click", "view", "purchase")),
        ("percentages do not add up", N.validate_percentages(F.array(F.col("value"), F.col("k").cast("double")))),
    ]
    found = N.errors(rules, [("missing field: event_type", kind.isNull())])
    extra = F.when(kind.isNotNull(), F.transform(loose, lambda x: F.concat(F.lit("dangling: "), x))).otherwise(F.array().cast("array<string>"))
    return rows.select("event_id", F.array_join(F.concat(found, extra), "; ").alias("errors"))


@register("batch_outputs", "SELECT user_id, event_id, value > 30 AS valid FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (value > 30) DESC, event_id DESC) = 1")
def batch_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("value") > 30).alias("valid"))
    return N.settle_batches(outputs, "user_id", ["event_id"], "valid")


@register("evidence_short", "SELECT conv_id, turn, CASE WHEN length(t) > 200 THEN substr(t, 1, 197) || '...' ELSE t END AS evidence FROM (SELECT conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM conversations)")
def evidence_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", N.short_evidence(F.col("text")).alias("evidence"))


_GRAMS = "CASE WHEN length(s) > 3 THEN list_distinct(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) WHEN length(s) > 0 THEN [s] ELSE [] END"
_SIGNAL = f"({_has(MARKERS.explicit)} > 0 OR {_has(MARKERS.strong)} > 0 OR regexp_matches(text, 'la.*der|ou la'))"
_CANDIDATES = f"""WITH t AS (SELECT conv_id, turn, turn * 100 AS seconds, role, text, ({_SCORE})::INT AS score, {_SIGNAL} AS signal, {_GRAMS} AS g FROM (SELECT *, lower(text) AS s FROM conversations)),
n AS (SELECT * FROM t WHERE role = 'user' AND turn % 4 = 0), c AS (SELECT * FROM t WHERE NOT (role = 'user' AND turn % 4 = 0)),
p AS (SELECT n.conv_id, n.turn AS note, c.turn AS chunk, c.seconds - n.seconds AS delta, c.score, c.signal, CASE WHEN len(n.g) > 0 AND len(c.g) > 0 THEN len(list_intersect(n.g, c.g)) / (len(n.g) + len(c.g) - len(list_intersect(n.g, c.g))) ELSE 0 END AS sim FROM n JOIN c ON n.conv_id = c.conv_id AND c.seconds - n.seconds BETWEEN -180 AND 180),
b AS (SELECT * FROM p WHERE delta BETWEEN -120 AND 150 AND (sim >= 0.035 OR (abs(delta) <= 45 AND score >= 5 AND signal))),
f AS (SELECT * FROM (SELECT * FROM p WHERE (conv_id, note) NOT IN (SELECT conv_id, note FROM b) QUALIFY row_number() OVER (PARTITION BY conv_id, note ORDER BY abs(delta), delta) = 1) WHERE sim >= 0.04 OR (score >= 6 AND signal)),
m AS (SELECT conv_id, note, count(*) AS k, round_even(max(sim), 4) AS sim, max(score) AS score FROM (SELECT * FROM b UNION ALL SELECT * FROM f) GROUP BY ALL)
SELECT n.conv_id, n.turn AS id, n.seconds, CASE WHEN k IS NULL THEN 'note' ELSE 'note+transcript' END AS kinds, k AS matched_chunk_count, m.sim AS match_similarity_max, m.score AS humor_score_max, 'high' AS confidence FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.note = n.turn
UNION ALL SELECT conv_id, turn, seconds, 'transcript', 1, NULL, score, CASE WHEN score >= 7 THEN 'medium' ELSE 'low' END FROM c WHERE score >= 5 AND signal AND NOT EXISTS (SELECT 1 FROM n WHERE n.conv_id = c.conv_id AND c.seconds - n.seconds BETWEEN -130 AND 160)"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", (F.col("turn") * 100).alias("seconds"), T.trigrams(F.lower("text")).alias("grams"), H.humor_score(text, MARKERS, F.length("text")).alias("score"), H.signal(text, MARKERS, "la.*der|ou la").alias("signal"))
    is_note = (F.col("role") == "user") & (F.col("turn") % 4 == 0)
    notes = turns.where(is_note).select("conv_id", F.col("turn").alias("note"), F.col("seconds").alias("at"), "grams")
    chunks = turns.where(~is_note).select("conv_id", F.col("turn").alias("chunk"), "seconds", "grams", "score", "signal")
    return H.candidates(notes, chunks, "conv_id", "note", "chunk")


@register("joke_candidates", _CANDIDATES)
def joke_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled passages with the transcript around them, and what the transcript has beside them; every fourth turn stands for a note."""
    return _candidates(spark, sf_dir)


@register("joke_summary", f"SELECT kinds, confidence, count(*) AS jokes, count(*) FILTER (contains(kinds, 'transcript')) AS with_transcript FROM ({_CANDIDATES}) GROUP BY kinds, confidence")
def joke_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by the kinds of sources, joined, and by confidence."""
    return _candidates(spark, sf_dir).groupBy("kinds", "confidence").agg(F.count(F.lit(1)).alias("jokes"), F.count_if(F.contains("kinds", F.lit("transcript"))).alias("with_transcript"))


@register("joke_extract")
def joke_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: candidates, their texts, those that repeat one another as one, and what kind each is. Greedy deduplication has no SQL."""
    found = _candidates(spark, sf_dir)
    texts = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("id"), "text")
    rows = found.join(texts, ["conv_id", "id"])
    merged = greedy.greedy_dedupe(rows.select(F.col("conv_id").alias("day"), "id", "seconds", F.lit("").alias("heading"), F.col("kinds").alias("kind"), T.bare(F.col("text")).alias("text")))
    first = merged.where("id = cluster").select(F.col("day").alias("conv_id"), "id", "cluster_size")
    final = rows.join(first, ["conv_id", "id"])
    print_ = F.substring(F.sha1(F.concat_ws(":", F.col("conv_id").cast("string"), times.clock(F.col("seconds")), F.substring(T.bare(F.col("text")), 1, 160))), 1, 8)
    return final.select("conv_id", "id", F.concat_ws("-", F.lit("joke"), F.col("conv_id").cast("string"), print_).alias("joke_id"), "kinds", "confidence", "cluster_size", H.first_class(F.col("text"), _TYPES, "other").alias("type"), F.length("text").alias("text_chars"))
