"""Queries over keyword dictionaries: counts, rollups, rankings, retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import text as T
from glossmark.operators import dictionary as D
from glossmark.plans.tables import DATED, dated, table
from glossmark.registry import oracle_sql, register

THEMES = {"growth": ["tion", "ing ", "The "], "risk": ["eau", "der ", "ou"], "macro": ["sch", "que", "ción"], "none": ["zzzz"]}
LABELS = {"growth": "growth trend", "risk": "risk control", "macro": "macro", "none": "none"}
QUESTION = "is the eau risk or tion growth que"


def _values(themes=THEMES) -> str:
    rows = ", ".join(f"('{t}', {i}, '{k}', {j})" for i, (t, ks) in enumerate(themes.items()) for j, k in enumerate(ks))
    return f"(VALUES {rows}) AS v(theme, theme_ord, keyword, keyword_ord)"


COUNTS = f"SELECT * FROM (SELECT doc_id, day, source, lang, theme, theme_ord, keyword, keyword_ord, ((length(text) - length(replace(text, keyword, ''))) // length(keyword))::BIGINT AS n FROM ({DATED}), {_values()}) WHERE n > 0"
HITS = f"SELECT doc_id, day, theme, sum(n)::BIGINT AS hit_count FROM ({COUNTS}) GROUP BY ALL"


def counts(spark: SparkSession, sf_dir: str, any_case: bool = False) -> DataFrame:
    return D.keyword_counts(dated(spark, sf_dir).select("doc_id", "day", "source", "lang", "text"), THEMES, any_case=any_case)


@register("theme_counts", f"SELECT doc_id, theme, keyword, n FROM ({COUNTS})")
def theme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).select("doc_id", "theme", "keyword", "n")


@register("theme_counts_ci", f"SELECT * FROM (SELECT doc_id, theme, keyword, len(regexp_extract_all(text, '(?i)' || keyword))::BIGINT AS n FROM documents, {_values()}) WHERE n > 0")
def theme_counts_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir, any_case=True).select("doc_id", "theme", "keyword", "n")


@register("theme_rollup", f"SELECT t.theme, count(DISTINCT doc_id) AS episode_count, coalesce(sum(n), 0)::BIGINT AS hit_count FROM (SELECT DISTINCT theme FROM {_values()}) t LEFT JOIN ({COUNTS}) c ON c.theme = t.theme GROUP BY t.theme")
def theme_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus memory of themes, those without hits included."""
    return D.rollup(counts(spark, sf_dir), "doc_id", THEMES, spark)


@register("theme_keyword_map", f"SELECT doc_id, theme, sum(n)::BIGINT AS hit_count, string_agg(keyword || '=' || n, ';' ORDER BY keyword COLLATE \"C\") AS keyword_counts FROM ({COUNTS}) GROUP BY doc_id, theme".replace(' COLLATE "C"', ""))
def theme_keyword_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = D.theme_hits(counts(spark, sf_dir), ["doc_id"])
    pairs = F.transform(F.map_entries("keyword_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return found.select("doc_id", "theme", "hit_count", F.array_join(pairs, ";").alias("keyword_counts"))


@register("theme_year_hist", f"SELECT theme, coalesce(CASE WHEN doc_id % 17 <> 0 THEN strftime(day, '%Y') END, 'unknown') AS year, count(*) AS episodes, sum(hit_count)::BIGINT AS hits FROM ({HITS}) GROUP BY ALL")
def theme_year_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits by year; documents without a date, one in 17 here, are `unknown`."""
    hits = counts(spark, sf_dir).groupBy("doc_id", "day", "theme").agg(F.sum("n").alias("hit_count"))
    year = F.coalesce(F.when(F.col("doc_id") % 17 != 0, F.date_format("day", "yyyy")), F.lit("unknown"))
    return hits.groupBy("theme", year.alias("year")).agg(F.count(F.lit(1)).alias("episodes"), F.sum("hit_count").alias("hits"))


@register("theme_top_episodes", f"SELECT theme, doc_id, hit_count, row_number() OVER (PARTITION BY theme ORDER BY hit_count DESC, doc_id) AS place FROM ({HITS}) QUALIFY place <= 30")
def theme_top_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = counts(spark, sf_dir).groupBy("doc_id", "theme").agg(F.sum("n").alias("hit_count"))
    return D.top_documents(hits, [F.desc("hit_count"), F.asc("doc_id")], 30)


@register("theme_top_by_date", f"SELECT theme, doc_id, hit_count, row_number() OVER (PARTITION BY theme ORDER BY hit_count DESC, day DESC, doc_id) AS place FROM ({HITS}) QUALIFY place <= 12")
def theme_top_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = counts(spark, sf_dir).groupBy("doc_id", "day", "theme").agg(F.sum("n").alias("hit_count"))
    return D.top_documents(hits, [F.desc("hit_count"), F.desc("day"), F.asc("doc_id")], 12).drop("day")


@register("theme_recent", f"SELECT theme, doc_id, day, row_number() OVER (PARTITION BY theme ORDER BY day DESC, doc_id DESC) AS place FROM ({HITS}) QUALIFY place <= 16")
def theme_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = counts(spark, sf_dir).select("doc_id", "day", "theme").distinct()
    return D.top_documents(hits, [F.desc("day"), F.desc("doc_id")], 16)


@register(
    "keyword_rank",
    f"SELECT theme, keyword, n, row_number() OVER (PARTITION BY theme ORDER BY n DESC, f) AS place FROM (SELECT theme, keyword, sum(n)::BIGINT AS n, min((doc_id, keyword_ord)) AS f FROM ({COUNTS}) GROUP BY ALL)",
)
def keyword_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.most_common(counts(spark, sf_dir), "doc_id")


ASSETS = {"AAA": ["tion", "Tion"], "BBB": ["eau"], "CCC": ["sch", "ung"]}


@register(
    "asset_rollup",
    """WITH c AS (SELECT * FROM (SELECT doc_id, source, symbol, keyword, ((length(text) - length(replace(text, keyword, ''))) // length(keyword))::BIGINT AS n
 FROM documents, (VALUES ('AAA', 'tion'), ('AAA', 'Tion'), ('BBB', 'eau'), ('CCC', 'sch'), ('CCC', 'ung')) v(symbol, keyword)) WHERE n > 0)
SELECT symbol AS asset, count(DISTINCT doc_id) AS episode_count, sum(n)::BIGINT AS hit_count, arg_max(source, doc_id) AS name, symbol, 'direct' AS kind,
 (SELECT string_agg(keyword || '=' || t, ';' ORDER BY t DESC, keyword) FROM (SELECT keyword, sum(n)::BIGINT AS t FROM c d WHERE d.symbol = c.symbol GROUP BY keyword)) AS aliases FROM c GROUP BY symbol""",
)
def asset_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets over the corpus: documents counted once, hits summed, the last document's description wins."""
    found = D.keyword_counts(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ASSETS)
    hits = found.select(F.col("doc_id").alias("ord"), F.col("doc_id").alias("source"), F.col("theme").alias("symbol"), F.col("source").alias("name"), F.lit("direct").alias("kind"), F.col("keyword").alias("alias"), "n")
    shown = F.transform("aliases", lambda x: F.concat(x["alias"], F.lit("="), x["n"].cast("string")))
    return D.asset_rollup(hits).withColumn("aliases", F.array_join(shown, ";"))


_RHETORIC = {"question": ["qu", "?"], "list": [", "], "turn": ["ou", "aber"]}


@register(
    "rhetoric_rollup",
    """WITH c AS (SELECT * FROM (SELECT conv_id, role, p, ((length(text) - length(replace(text, k, ''))) // length(k))::BIGINT AS n
 FROM conversations, (VALUES ('question', 'qu'), ('question', '?'), ('list', ', '), ('turn', 'ou'), ('turn', 'aber')) v(p, k)) WHERE n > 0)
SELECT p AS pattern, role, count(DISTINCT conv_id) AS episode_count, sum(n)::BIGINT AS hit_count FROM c GROUP BY ALL""",
)
def rhetoric_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = D.keyword_counts(table(spark, sf_dir, "conversations").select("conv_id", "role", "text"), _RHETORIC)
    return found.groupBy(F.col("theme").alias("pattern"), "role").agg(F.count_distinct("conv_id").alias("episode_count"), F.sum("n").alias("hit_count"))


@register("risk_rules", f"SELECT DISTINCT doc_id, theme AS rule_id, CASE WHEN theme = 'macro' THEN 'wait' ELSE 'hold' END AS action FROM ({COUNTS})")
def risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules a document touches, in dictionary terms; one of them waits, the others hold."""
    action = F.when(F.col("theme") == "macro", "wait").otherwise("hold")
    return counts(spark, sf_dir).select("doc_id", F.col("theme").alias("rule_id"), action.alias("action")).distinct()


_UP, _DOWN, _RISK = ["tion", "ing"], ["eau", "sch"], ["ou", "ion"]


def _sum_sql(words: list[str]) -> str:
    return " + ".join(f"(length(s) - length(replace(s, '{w}', ''))) // {len(w)}" for w in words)


@register(
    "headline_class",
    f"""SELECT doc_id, CASE WHEN r >= 2 AND d >= 1 THEN 'risk_control' WHEN u > 0 AND d > 0 THEN 'mixed' WHEN u > 0 THEN 'bullish' WHEN d > 0 THEN 'bearish' ELSE 'unknown' END AS direction,
 CASE WHEN contains(s, 'today') THEN 'intraday' WHEN contains(s, 'que') THEN 'monthly' WHEN contains(s, 'the') THEN 'multi_month' ELSE 'swing' END AS horizon, CASE WHEN u > 0 OR d > 0 THEN 'medium' ELSE 'low' END AS confidence
 FROM (SELECT doc_id, s, {_sum_sql(_UP)} AS u, {_sum_sql(_DOWN)} AS d, {_sum_sql(_RISK)} AS r FROM (SELECT doc_id, substr(text, 1, 40) || ' ' || text AS s FROM documents))""",
)
def headline_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction and horizon from cues in title and body; the title, which the first 40 characters stand for, counts again as it
    begins the body. The reference stops at 2,500 characters of the body; here no cue is lost behind them."""
    return _headlines(spark, sf_dir, F.col("text"))


@register("headline_class_whole", oracle_sql()["headline_class"])
def headline_class_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that headline_class had while that one read beginnings."""
    return headline_class(spark, sf_dir)


def _headlines(spark: SparkSession, sf_dir: str, body: Column) -> DataFrame:
    s = F.concat(F.substring("text", 1, 40), F.lit(" "), body)
    total = lambda words: sum((T.count_literal(F.col("s"), w) for w in words), F.lit(0))
    rows = table(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", "s", total(_UP).alias("u"), total(_DOWN).alias("d"), total(_RISK).alias("r"))
    direction = F.when((F.col("r") >= 2) & (F.col("d") >= 1), "risk_control").when((F.col("u") > 0) & (F.col("d") > 0), "mixed").when(F.col("u") > 0, "bullish").when(F.col("d") > 0, "bearish").otherwise("unknown")
    horizon = F.when(F.contains("s", F.lit("today")), "intraday").when(F.contains("s", F.lit("que")), "monthly").when(F.contains("s", F.lit("the")), "multi_month").otherwise("swing")
    confidence = F.when(direction != "unknown", "medium").otherwise("low")
    return rows.select("doc_id", direction.alias("direction"), horizon.alias("horizon"), confidence.alias("confidence"))


def _scored_values(per_keyword: int) -> str:
    return ", ".join(f"('{t}', {i}, {s})" for t, i, s in D.score_query(QUESTION, THEMES, LABELS, per_keyword))


_ROLLED = f"SELECT theme, count(DISTINCT doc_id) AS episode_count, sum(n)::BIGINT AS hit_count FROM ({COUNTS}) GROUP BY theme"


def _chosen(spark: SparkSession, sf_dir: str, per_keyword: int) -> DataFrame:
    scored = spark.createDataFrame(D.score_query(QUESTION, THEMES, LABELS, per_keyword), "theme string, theme_ord int, score int")
    return D.choose_themes(D.rollup(counts(spark, sf_dir), "doc_id"), scored, 2, ["risk", "macro"])


@register(
    "score_theme",
    f"SELECT v.theme, score, episode_count, hit_count FROM (VALUES {_scored_values(5)}) v(theme, theme_ord, score) LEFT JOIN ({_ROLLED}) r ON r.theme = v.theme WHERE score > 0 ORDER BY score DESC, theme_ord LIMIT 2",
)
def score_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The themes a question asks for, from the corpus memory: a top-k report."""
    return _chosen(spark, sf_dir, 5).select("theme", "score", "episode_count", "hit_count")


@register(
    "evidence_score",
    f"""WITH c AS (SELECT theme FROM (VALUES {_scored_values(7)}) v(theme, theme_ord, score) WHERE score > 0 ORDER BY score DESC, theme_ord LIMIT 2)
SELECT doc_id, day, sum(n * CASE WHEN contains('{QUESTION}', lower(keyword)) THEN 6 ELSE 1 END)::BIGINT AS score FROM ({COUNTS}) WHERE theme IN (SELECT theme FROM c) GROUP BY doc_id, day""",
)
def evidence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document has for a question. Where the question names themes, only their keywords are counted, in one scan of the texts."""
    best = D.best_themes(D.score_query(QUESTION, THEMES, LABELS, 7), 2)
    if not best:
        return D.evidence_scores(counts(spark, sf_dir), ["doc_id", "day"], _chosen(spark, sf_dir, 7), QUESTION)
    found = D.keyword_counts(dated(spark, sf_dir).select("doc_id", "day", "text"), {t: THEMES[t] for t in best})
    return D.evidence_scores(found, ["doc_id", "day"], spark.createDataFrame([(t,) for t in best], "theme string"), QUESTION)


@register(
    "evidence_top",
    f"""WITH c AS (SELECT theme FROM (VALUES {_scored_values(7)}) v(theme, theme_ord, score) WHERE score > 0 ORDER BY score DESC, theme_ord LIMIT 2),
e AS (SELECT doc_id, day, sum(n * CASE WHEN contains('{QUESTION}', lower(keyword)) THEN 6 ELSE 1 END)::BIGINT AS score FROM ({COUNTS}) WHERE theme IN (SELECT theme FROM c) GROUP BY doc_id, day)
SELECT * FROM e ORDER BY score DESC, day DESC, doc_id DESC LIMIT 8""",
)
def evidence_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight documents with most evidence for a question."""
    return evidence_score(spark, sf_dir).orderBy(F.desc("score"), F.desc("day"), F.desc("doc_id")).limit(8)


_SNIPPET_KEYS = {"risk": ["eau", "ou"], "macro": ["sch", "que"]}
_EVIDENCE = f"""WITH c AS (SELECT theme FROM (VALUES {_scored_values(7)}) v(theme, theme_ord, score) WHERE score > 0 ORDER BY score DESC, theme_ord LIMIT 2),
e AS (SELECT doc_id, day, sum(n * CASE WHEN contains('{QUESTION}', lower(keyword)) THEN 6 ELSE 1 END)::BIGINT AS score FROM ({COUNTS}) WHERE theme IN (SELECT theme FROM c) GROUP BY doc_id, day)"""


@register("evidence_recent", _EVIDENCE + " SELECT * FROM e WHERE day >= DATE '1999-01-01' ORDER BY score DESC, day DESC, doc_id DESC LIMIT 6")
def evidence_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the recent documents the six with most evidence, newer ones first among equals."""
    return evidence_score(spark, sf_dir).where(F.col("day") >= "1999-01-01").orderBy(F.desc("score"), F.desc("day"), F.desc("doc_id")).limit(6)


def theme_snippets(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, theme, place, keyword, start): up to three snippets of each theme in a document, in their stored order."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = rows if docs is None else rows.join(docs.select("doc_id"), "doc_id", "left_semi")
    found = [F.struct(F.lit(t).alias("theme"), T.ordered_snippets(F.col("text"), ks).alias("found")) for t, ks in _SNIPPET_KEYS.items()]
    each = rows.select("doc_id", F.explode(F.array(*found)).alias("t")).select("doc_id", "t.theme", F.posexplode("t.found").alias("place", "s"))
    return each.select("doc_id", "theme", "place", "s.keyword", "s.start")


def _snippet_sql(limit: int) -> str:
    keys = ", ".join(f"('{t}', '{k}', {i})" for t, ks in _SNIPPET_KEYS.items() for i, k in enumerate(ks))
    return f"""k(theme, keyword, ord) AS (VALUES {keys}),
p AS (SELECT doc_id, theme, keyword, ord, unnest(string_split(lower(text), keyword)) AS piece, generate_subscripts(string_split(lower(text), keyword), 1) AS i FROM documents SEMI JOIN t USING (doc_id), k),
h AS (SELECT doc_id, theme, keyword, ord, i, (sum(length(piece)) OVER (PARTITION BY doc_id, theme, ord ORDER BY i) + (i - 1) * length(keyword))::INT AS start, count(*) OVER (PARTITION BY doc_id, theme, ord) AS n FROM p),
f AS (SELECT doc_id, theme, keyword, start, row_number() OVER (PARTITION BY doc_id, theme ORDER BY ord, start) AS place FROM h WHERE i < n AND (i = 1 OR start > 80)),
s AS (SELECT f.*, row_number() OVER (PARTITION BY doc_id ORDER BY CASE theme WHEN 'risk' THEN 0 ELSE 1 END, place)::INT AS nth FROM f WHERE place <= 3 QUALIFY nth <= {limit})"""


@register("evidence_snippets", _EVIDENCE + f", t AS (SELECT * FROM e ORDER BY score DESC, day DESC, doc_id DESC LIMIT 8), {_snippet_sql(3)} SELECT doc_id, score, theme, nth, keyword, start FROM t JOIN s USING (doc_id)")
def evidence_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with most evidence, each with its first three snippets over the chosen themes, theme by theme."""
    top = evidence_top(spark, sf_dir)
    ranks = spark.createDataFrame([("risk", 0), ("macro", 1)], "theme string, theme_rank int")
    found = D.first_snippets(theme_snippets(spark, sf_dir, top), ranks, "doc_id", 3)
    return top.select("doc_id", "score").join(found, "doc_id").select("doc_id", "score", "theme", "nth", "keyword", "start")


@register(
    "note_assets",
    """WITH c AS (SELECT doc_id, symbol, sum(n)::BIGINT AS hits FROM (SELECT doc_id, symbol, ((length(text) - length(replace(text, keyword, ''))) // length(keyword))::BIGINT AS n
 FROM documents, (VALUES ('AAA', 'tion'), ('AAA', 'Tion'), ('BBB', 'eau'), ('CCC', 'sch'), ('CCC', 'ung')) v(symbol, keyword)) WHERE n > 0 GROUP BY ALL)
SELECT doc_id, symbol, hits, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, symbol)::INT AS place, CASE WHEN symbol = 'AAA' AND doc_id IN (SELECT doc_id FROM labels) THEN 'priced_in_episode_asset_context' END AS context_status FROM c QUALIFY place <= 20""",
)
def note_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty assets a document names most, and whether its asset context has priced them; labels stand for that context."""
    from glossmark.operators import mentions as M

    found = D.keyword_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), ASSETS).groupBy("doc_id", F.col("theme").alias("symbol")).agg(F.sum("n").alias("hits"))
    top = D.top_documents(found, [F.desc("hits"), F.asc("symbol")], 20, "doc_id")
    direct = table(spark, sf_dir, "labels").select("doc_id", F.lit("AAA").alias("symbol"))
    return M.with_context_flag(top, direct, ["doc_id"]).select("doc_id", "symbol", "hits", "place", "context_status")
