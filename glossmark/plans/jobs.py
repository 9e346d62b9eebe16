"""Whole jobs: per-document notes out of several operators, and summaries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.checkpoints import settled
from glossmark.operators import dictionary as D
from glossmark.operators import memory as Y
from glossmark.operators import mentions as M
from glossmark.operators import notes as N
from glossmark.operators import prices
from glossmark.operators import sync as S
from glossmark.plans import market, passages, search, sync, themes
from glossmark.plans.tables import BARS, DATED, bars, dated, table
from glossmark.registry import oracle_sql, register
from glossmark.sources import discovery, intervals, sinks
from glossmark.streaming import supervisor

_SQL = oracle_sql()


@register(
    "deterministic_notes",
    f"""WITH h AS ({themes.HITS}), o AS (SELECT DISTINCT theme, theme_ord FROM ({themes.COUNTS})),
t AS (SELECT doc_id, count(*) AS themes, sum(hit_count)::BIGINT AS hits, arg_max(theme, hit_count * 100 - theme_ord) AS top_theme FROM h JOIN o USING (theme) GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS assets FROM ({search.DIRECT}) GROUP BY doc_id)
SELECT d.doc_id, regime, direction, horizon, confidence, coalesce(themes, 0) AS themes, coalesce(hits, 0) AS hits, coalesce(top_theme, '') AS top_theme, coalesce(assets, 0) AS assets
FROM documents d JOIN ({_SQL["regime_4"]}) r ON r.doc_id = d.doc_id JOIN ({_SQL["headline_class"]}) c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id""",
)
def deterministic_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A note for each document from rules alone: regime of its day, headline, themes, assets."""
    return _notes(spark, sf_dir, themes.headline_class(spark, sf_dir))


@register("deterministic_notes_whole", oracle_sql()["deterministic_notes"])
def deterministic_notes_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that deterministic_notes had while that one read beginnings."""
    return deterministic_notes(spark, sf_dir)


def _notes(spark: SparkSession, sf_dir: str, headlines: DataFrame) -> DataFrame:
    hits = themes.counts(spark, sf_dir).groupBy("doc_id", "theme", "theme_ord").agg(F.sum("n").alias("hit_count"))
    of_themes = hits.groupBy("doc_id").agg(F.count(F.lit(1)).alias("themes"), F.sum("hit_count").alias("hits"), F.max_by("theme", F.struct("hit_count", F.negate("theme_ord"))).alias("top_theme"))
    assets = search.alias_mentions(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("assets"))
    notes = market.regime_4(spark, sf_dir).join(headlines, "doc_id").join(of_themes, "doc_id", "left").join(assets, "doc_id", "left")
    return notes.fillna(0, ["themes", "hits", "assets"]).fillna("", ["top_theme"])


_ERRORS = "SELECT event_id, CASE WHEN starts_with(e, 'dangling') THEN 'dangling' ELSE e END AS error FROM (SELECT event_id, unnest(string_split(errors, '; ')) AS e FROM ({})) WHERE e <> ''"


@register("validation_summary", f"SELECT error, count(*) AS notes FROM ({_ERRORS.format(_SQL['note_validate'])}) GROUP BY error")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule with the number of times it is broken; dangling references are one rule, whatever they refer to."""
    errors = passages.note_validate(spark, sf_dir).select(F.explode(F.split("errors", "; ")).alias("error")).where("error <> ''")
    rule = F.when(F.startswith("error", F.lit("dangling")), "dangling").otherwise(F.col("error"))
    return errors.groupBy(rule.alias("error")).agg(F.count(F.lit(1)).alias("notes"))


@register(
    "validation_totals",
    f"""WITH k AS (SELECT v.event_id, v.errors FROM ({_SQL["note_validate"]}) v JOIN events e ON e.event_id = v.event_id WHERE e.props IS NOT NULL),
t AS (SELECT (SELECT count(*) FROM events) AS target, (SELECT count(*) FROM k WHERE errors = '') AS valid, (SELECT count(*) FROM events WHERE props IS NULL) AS missing, (SELECT count(*) FROM k WHERE errors <> '') AS invalid),
r AS (SELECT error, count(DISTINCT event_id) AS notes FROM ({_ERRORS.format("SELECT * FROM k")}) GROUP BY error)
SELECT target, valid, missing, invalid, error, notes FROM t LEFT JOIN r ON true""",
)
def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, valid, missing and invalid counts beside the notes of each error, dangling references included.

    Each event is a target, and one without properties has no note."""
    events = table(spark, sf_dir, "events")
    checked = passages.note_validate(spark, sf_dir).join(events.where("props is not null").select("event_id"), "event_id", "left_semi")
    found = checked.select("event_id", F.filter(F.split("errors", "; "), lambda e: e != "").alias("errors"))
    return N.summary(events.select("event_id"), found, "event_id")


@register(
    "changed_rollup",
    f"WITH c AS ({_SQL['signature_diff']}) SELECT theme, change, count(DISTINCT k.doc_id) AS episode_count, sum(n)::BIGINT AS hit_count FROM ({themes.COUNTS}) k JOIN c ON c.doc_id = k.doc_id GROUP BY ALL",
)
def changed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a daily run has to redo: theme hits of the documents that the diff names, and of no others."""
    changed = sync.signature_diff(spark, sf_dir)
    counts = themes.counts(spark, sf_dir).join(changed, "doc_id")
    return counts.groupBy("theme", "change").agg(F.count_distinct("doc_id").alias("episode_count"), F.sum("n").alias("hit_count"))


_ALL_MENTIONS = f"""WITH direct AS (SELECT doc_id, symbol, matched_aliases, 'transcript' AS sources FROM ({search.DIRECT})), seen AS ({search.SECTOR_SEEN}),
named AS (SELECT DISTINCT doc_id, symbol, '' AS matched_aliases, 'trade_observations.asset_symbol' AS sources FROM ({search.OBSERVED}) WHERE symbol IN ('AAA', 'BBB', 'CCC')),
m AS (SELECT * FROM direct UNION ALL SELECT * FROM seen UNION ALL SELECT * FROM named UNION ALL SELECT * FROM ({_SQL["proxy_minus_direct"]})),
a AS (SELECT doc_id, symbol, string_agg(DISTINCT x, ',' ORDER BY x) AS matched_aliases FROM (SELECT doc_id, symbol, unnest(string_split(matched_aliases, ',')) AS x FROM m) WHERE x <> '' GROUP BY ALL),
s AS (SELECT doc_id, symbol, string_agg(DISTINCT x, ',' ORDER BY x) AS sources FROM (SELECT doc_id, symbol, unnest(string_split(sources, ',')) AS x FROM m) GROUP BY ALL)"""


def asset_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, target, symbol, matched_aliases, sources): what each document mentions, with the day whose prices it could know, from one scan."""
    asset, symbol = search.observed_columns()
    docs = dated(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.date_sub("day", 1200)).alias("target"), "text", asset.alias("asset"), symbol.alias("symbol"))
    return search._flat(M.context_mentions(docs, ["doc_id", "target"], search.ALIASES, search.SECTORS, search.MEMBERS))


@register(
    "asset_context",
    f"""{_ALL_MENTIONS}, b AS ({BARS}),
t AS (SELECT s.doc_id, s.symbol, coalesce(matched_aliases, '') AS matched_aliases, sources, CASE s.symbol WHEN 'AAA' THEN '1-URGENT' WHEN 'BBB' THEN '' ELSE 'CCC' END AS price_symbol, CASE WHEN s.doc_id % 11 <> 0 THEN day - 1200 END AS target
 FROM s LEFT JOIN a ON a.doc_id = s.doc_id AND a.symbol = s.symbol JOIN ({DATED}) d ON d.doc_id = s.doc_id),
j AS (SELECT t.*, b.d, b.close FROM t ASOF LEFT JOIN b ON t.price_symbol = b.symbol AND t.target >= b.d)
SELECT doc_id, symbol, matched_aliases, sources, price_symbol, d AS price_day, close, CASE WHEN target IS NULL THEN 'missing_episode_date' WHEN price_symbol = '' THEN 'no_public_symbol' WHEN price_symbol NOT IN (SELECT symbol FROM b) THEN 'missing_price_series' WHEN d IS NULL THEN 'no_prior_price' ELSE 'ok' END AS status FROM j""",
)
def asset_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset context as one job: what each document mentions by alias, what its notes observe, sectors' members that it doesn't mention itself, all
    united by asset, with the last price known at its time or why there is none."""
    rows = settled(asset_mentions(spark, sf_dir))  # few rows beside the texts, read twice
    overrides = F.create_map(F.lit("AAA"), F.lit("1-URGENT"), F.lit("BBB"), F.lit(""))
    symbol = prices.pricing_symbol(F.col("symbol"), overrides[F.col("symbol")], F.col("symbol").isin("AAA", "BBB"))
    rows = rows.withColumn("price_symbol", symbol)
    closes = bars(spark, sf_dir).withColumnRenamed("symbol", "price_symbol")
    series = closes.select("price_symbol").distinct().withColumn("has_series", F.lit(True))
    priced = prices.as_of_keys(rows, closes, "price_symbol").join(series, "price_symbol", "left")
    status = prices.pricing_status(F.col("target").isNotNull(), F.col("price_symbol"), F.coalesce("has_series", F.lit(False)), F.col("d").isNotNull())
    return priced.select("doc_id", "symbol", "matched_aliases", "sources", "price_symbol", F.col("d").alias("price_day"), "close", status.alias("status"))


@register(
    "feed_sync",
    f"""WITH f AS (SELECT doc_id, substr(text, 1, 40) AS title, CASE WHEN doc_id % 10 <> 0 THEN strftime(day, '%Y-%m-%d') END AS pub, CASE WHEN doc_id % 6 <> 0 THEN 'a' || doc_id END AS audio FROM ({DATED}) SEMI JOIN ({_SQL["author_relevance"]} WHERE source = 'src3' OR score >= 2) r USING (doc_id)),
o AS (SELECT doc_id, CASE WHEN quality = 1 THEN 't' || doc_id ELSE '' END AS transcript, CASE WHEN toxic = 1 THEN 'error' ELSE 'done' END AS status FROM labels)
SELECT f.doc_id, title, pub, audio, nullif(o.transcript, '') AS transcript, CASE WHEN coalesce(o.transcript, '') <> '' THEN 'done' WHEN o.status = 'error' THEN 'error' WHEN audio IS NOT NULL THEN 'pending' ELSE 'missing_audio' END AS status,
 row_number() OVER (ORDER BY coalesce(pub, '') DESC, f.doc_id) AS place FROM f LEFT JOIN o ON f.doc_id = o.doc_id""",
)
def feed_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed brought into its manifest as one job: the items that are the author's, with what the manifest knew of their transcripts and errors, their
    status now, and their places, newest first. Documents stand for items, labels for the manifest."""
    items = dated(spark, sf_dir).select("doc_id", F.substring("text", 1, 40).alias("title"), F.when(F.col("doc_id") % 10 != 0, F.date_format("day", "yyyy-MM-dd")).alias("pub"), F.when(F.col("doc_id") % 6 != 0, F.concat(F.lit("a"), F.col("doc_id").cast("string"))).alias("audio"))
    mine = items.join(search.author_relevance(spark, sf_dir).where("included").select("doc_id"), "doc_id", "left_semi")
    old = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, F.concat(F.lit("t"), F.col("doc_id").cast("string"))).otherwise("").alias("transcript"), F.when(F.col("toxic") == 1, "error").otherwise("done").alias("status"))
    nothing = F.lit(None).cast("string")
    merged = S.upsert_preserving(mine.withColumns({"transcript": nothing, "status": nothing}), old, "doc_id", ["transcript", "status"])
    status = S.recording_status(F.coalesce("transcript", F.lit("")) != "", F.coalesce("status", F.lit("")), F.col("audio"))
    return S.placed(merged.withColumn("status", status), S.newest_first(F.col("pub"), F.col("doc_id")))


@register("daily_sync", f"WITH c AS ({oracle_sql()['changed_rollup']}) SELECT c.*, g.reason FROM c, ({_SQL['daily_gate']}) g WHERE g.due")
def daily_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily run: nothing where today's is done and nothing waits; else the memory of what the diff of sources names, and why it ran."""
    gate = sync.daily_gate(spark, sf_dir).where("due")
    return changed_rollup(spark, sf_dir).crossJoin(gate.select("reason"))


def _version(k: int) -> str:
    """The k-th of derived versions of the documents: each lacks some, and some texts come twice over."""
    return f"SELECT doc_id, CASE WHEN doc_id % 5 = {k} THEN text || ' ' || text ELSE text END AS text FROM documents WHERE doc_id % 7 <> {k}"


def _memory_sql(k: int) -> str:
    counts = themes.COUNTS.replace(DATED, f"SELECT v.*, source, lang, day FROM ({_version(k)}) v JOIN (SELECT doc_id, source, lang, day FROM ({DATED})) USING (doc_id)")
    flat = f"SELECT doc_id, unnest(['theme', 'year', 'keyword']) AS part, theme AS k1, unnest(['', strftime(day, '%Y'), keyword]) AS k2, n FROM ({counts})"
    return f"SELECT part, k1, k2, count(DISTINCT doc_id) AS docs, sum(n)::BIGINT AS hits FROM ({flat}) GROUP BY ALL"


def _contributions(docs: DataFrame) -> DataFrame:
    counts = D.keyword_counts(docs, themes.THEMES)
    parts = {"theme": (F.col("theme"), F.lit("")), "year": (F.col("theme"), F.date_format("day", "yyyy")), "keyword": (F.col("theme"), F.col("keyword"))}
    return Y.contributions(counts, "doc_id", parts)


@register("memory_kept_current", _memory_sql(3))
def memory_kept_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The memory of themes, by year and by keyword, built once and then brought through three differences of sources, each of which reads only the texts
    that were added or changed; equal to building it anew from the last version."""

    def version(k: int) -> DataFrame:
        text = F.when(F.col("doc_id") % 5 == k, F.concat("text", F.lit(" "), "text")).otherwise(F.col("text"))
        return dated(spark, sf_dir).where(F.col("doc_id") % 7 != k).select("doc_id", "day", text.alias("text"))

    def signed(k: int) -> DataFrame:
        return version(k).select("doc_id", F.sha2("text", 256).alias("s"))

    kept = settled(_contributions(version(0)))
    memory = Y.memory(kept)
    for k in (1, 2, 3):
        changes = settled(S.signature_diff(signed(k - 1), signed(k), "doc_id", "s").withColumnRenamed("doc_id", "doc"))
        come = version(k).join(changes.where("change <> 'removed'").select(F.col("doc").alias("doc_id")), "doc_id", "left_semi")
        memory, kept = Y.updated(memory, kept, changes, settled(_contributions(come)))
        memory, kept = settled(memory), settled(kept)
    return memory


_RUN = "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'pending' ELSE 'running' END"
_RUN_SILENT = 86_400


@register(
    "run_states",
    f"""WITH e AS (SELECT user_id AS key, ts::TIMESTAMP AS stamp, {_RUN} AS status FROM events),
w AS (SELECT *, lag(status) OVER o AS was, lag(stamp) OVER o AS was_at FROM e WINDOW o AS (PARTITION BY key ORDER BY stamp, status)),
l AS (SELECT key, arg_max(status, (stamp, status)) AS status, max(stamp) AS stamp, count(*) FILTER (status = 'running' AND (coalesce(was, '') <> 'running' OR epoch_us(stamp) - epoch_us(was_at) >= {_RUN_SILENT * 1_000_000})) AS attempts FROM w GROUP BY key),
h AS (SELECT *, status = 'running' AND (SELECT epoch_us(max(stamp)) FROM e) - epoch_us(stamp) >= {_RUN_SILENT * 1_000_000} AS hung FROM l)
SELECT key, CASE WHEN hung THEN 'error' ELSE status END AS status, CASE WHEN hung THEN '{supervisor.SILENT} for {_RUN_SILENT} s' WHEN status = 'error' THEN 'failed' END AS error, attempts::INT AS attempts FROM h""",
)
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the supervisor of runs has come to at the end of the log, users standing for runs: the batch that its stream is held against."""
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "pending").otherwise("running")
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("at"), kind.alias("status"), F.lit("failed").alias("error"))
    return supervisor.replayed(log, _RUN_SILENT).drop("at")


_WANTED = "SELECT user_id AS symbol, ts::DATE AS since, ts::DATE + (event_id % 9)::INT AS until FROM events WHERE event_id % 3 <> 0"
_FETCHED = "SELECT user_id AS symbol, ts::DATE - (event_id % 5)::INT AS since, ts::DATE + (event_id % 4)::INT - 1 AS until FROM events WHERE event_id % 3 = 0"


@register(
    "series_gaps",
    f"""WITH d AS (SELECT DISTINCT symbol, unnest(generate_series(since, until, INTERVAL 1 DAY))::DATE AS d FROM ({_WANTED}) EXCEPT SELECT symbol, unnest(generate_series(since, until, INTERVAL 1 DAY))::DATE FROM ({_FETCHED}) WHERE until >= since),
g AS (SELECT symbol, d, d - (row_number() OVER (PARTITION BY symbol ORDER BY d))::INT AS island FROM d)
SELECT symbol, min(d) AS since, max(d) AS until FROM g GROUP BY symbol, island""",
)
def series_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of daily series that are wanted and weren't fetched, by user: events stand for both."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("symbol"), F.col("ts").cast("date").alias("day"), "event_id")
    span = lambda before, after: [F.date_sub("day", before.cast("int")).alias("since"), F.date_add("day", after.cast("int")).alias("until")]
    k = F.col("event_id")
    wanted = events.where("event_id % 3 <> 0").select("symbol", *span(F.lit(0), k % 9))
    fetched = events.where("event_id % 3 = 0").select("symbol", *span(k % 5, k % 4 - 1))
    return intervals.gaps(wanted, fetched, "symbol")


_LINKS = "SELECT page_id AS page, (page_id * 2 + strlen(html) % 5) % n AS \"to\" FROM pages, (SELECT count(*) AS n FROM pages) WHERE html IS NOT NULL UNION ALL SELECT page_id, (page_id + 7) % n FROM pages, (SELECT count(*) AS n FROM pages) WHERE page_id % 3 = 0"


@register(
    "site_crawl",
    f"""WITH RECURSIVE links AS ({_LINKS}), c AS (SELECT page_id AS page, 0 AS depth FROM pages WHERE page_id % 50 = 1 UNION SELECT "to", depth + 1 FROM c JOIN links USING (page) WHERE depth < 6 AND "to" % 11 <> 0)
SELECT page, min(depth) AS depth FROM c GROUP BY page""",
)
def site_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that a crawl reaches in six steps from some of them, each at its least depth; links are made of ids and lengths, as pages have none to each other."""
    pages = table(spark, sf_dir, "pages")
    n = pages.count()
    one = pages.where("html is not null").select(F.col("page_id").alias("page"), ((F.col("page_id") * 2 + F.octet_length("html") % 5) % n).alias("to"))
    links = settled(one.unionByName(pages.where("page_id % 3 = 0").select(F.col("page_id").alias("page"), ((F.col("page_id") + 7) % n).alias("to"))))
    seeds = pages.where("page_id % 50 = 1").select(F.col("page_id").alias("page"))
    return discovery.crawl(links, seeds, settled, 6, lambda page: page % 11 != 0)


_LINE = "doc_id || ':' || coalesce(text, '')"


@register(
    "request_batches",
    f"""WITH l AS (SELECT doc_id, strlen({_LINE}) + 1 AS size FROM documents), m AS (SELECT max(size) AS longest FROM l)
SELECT doc_id, ((sum(size) OVER (ORDER BY doc_id) - size) // (1000000 - longest + 1))::BIGINT AS batch FROM l, m""",
)
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In which file of requests each document goes, so that files stay below a million bytes and keep the order."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.coalesce("text", F.lit(""))).alias("value"))
    return sinks.request_batches(lines, "doc_id", 1_000_000).select("doc_id", "batch")
