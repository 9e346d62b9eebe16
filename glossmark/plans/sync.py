"""Queries over merges, upserts, diffs and queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.operators import search as Q
from glossmark.operators import sync as S
from glossmark.plans.tables import DATED, dated, table
from glossmark.registry import register


@register(
    "signature_diff",
    """WITH a AS (SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN sha256(text) END AS s, 1 AS here FROM documents WHERE doc_id % 7 <> 0),
b AS (SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN sha256(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END) END AS s, 1 AS here FROM documents WHERE doc_id % 11 <> 0)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.here IS NULL THEN 'added' WHEN b.here IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b USING (doc_id) WHERE a.here IS NULL OR b.here IS NULL OR a.s IS DISTINCT FROM b.s""",
)
def signature_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two derived versions of the documents, by signature: what was added, changed, removed. One signature in 13 is null in both."""
    docs = table(spark, sf_dir, "documents")
    signed = lambda text: F.when(F.col("doc_id") % 13 != 0, F.sha2(text, 256)).alias("s")
    before = docs.where("doc_id % 7 <> 0").select("doc_id", signed(F.col("text")))
    after = docs.where("doc_id % 11 <> 0").select("doc_id", signed(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))))
    return S.signature_diff(before, after, "doc_id", "s")


@register(
    "source_merge_full",
    "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, coalesce(nullif(d.title, ''), l.title) AS title, CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'both' WHEN d.doc_id IS NOT NULL THEN 'preferred' ELSE 'other' END AS kind FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE substr(text, 1, 20) END AS title FROM documents WHERE doc_id % 4 <> 0) d FULL JOIN (SELECT doc_id, 'note ' || quality AS title FROM labels) l ON d.doc_id = l.doc_id",
)
def source_merge_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    transcripts = table(spark, sf_dir, "documents").where("doc_id % 4 <> 0").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.substring("text", 1, 20)).alias("title"))
    notes = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("note "), F.col("quality").cast("string")).alias("title"))
    return S.full_merge(transcripts, notes, ["doc_id"], ["title"])


@register(
    "keyed_merge",
    "SELECT user_id, arg_min(event_type, event_id) FILTER (event_id % 3 <> 0) AS title, arg_max(event_type, event_id) FILTER (event_id % 3 <> 0) AS latest, string_agg(path, ',' ORDER BY first_seen) AS paths FROM (SELECT *, min(event_id) OVER (PARTITION BY user_id, path) AS first_seen, row_number() OVER (PARTITION BY user_id, path ORDER BY event_id) AS rn FROM (SELECT *, event_type || '/' || event_id % 4 AS path FROM events)) GROUP BY user_id".replace("string_agg(path, ',' ORDER BY first_seen)", "string_agg(path, ',' ORDER BY first_seen) FILTER (rn = 1)"),
)
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one key as one: first non-empty title, last non-empty metadata, distinct paths in order."""
    title = F.when(F.col("event_id") % 3 != 0, F.col("event_type")).otherwise("")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", title.alias("title"), title.alias("latest"), F.concat("event_type", F.lit("/"), (F.col("event_id") % 4).cast("string")).alias("paths"))
    return S.keyed_merge(rows, "user_id", "event_id", ["title"], "paths", ["latest"]).withColumn("paths", F.array_join("paths", ","))


@register("status_last_wins", "SELECT user_id, event_id, event_type AS status, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def status_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("status"), "value", "ts")
    return S.last_by_key(log, ["user_id"], ["ts", "event_id"]).drop("ts")


@register(
    "status_merge",
    """WITH q AS (SELECT c_custkey AS id, 'pending' AS status, CASE WHEN c_custkey % 2 = 0 THEN 'old error' END AS error, 'audio' || c_custkey AS audio FROM customer),
s AS (SELECT user_id AS id, CASE event_type WHEN 'click' THEN 'done' WHEN 'view' THEN '' ELSE event_type END AS status, event_type <> 'error' AS has_status, 'e' || event_id AS error, event_type = 'error' AS has_error FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
j AS (SELECT q.id, q.audio, q.status AS s0, q.error AS e0, CASE WHEN has_status THEN nullif(s.status, '') ELSE q.status END AS status, CASE WHEN s.status = 'done' THEN NULL WHEN has_error THEN s.error ELSE q.error END AS error FROM q LEFT JOIN s ON q.id = s.id)
SELECT id, audio, status, error, (status IS DISTINCT FROM s0) OR (error IS DISTINCT FROM e0) AS changed FROM j""",
)
def status_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status log over a queue: last row wins, empty values delete, done clears the error."""
    key = F.col("c_custkey")
    queue = table(spark, sf_dir, "customer").select(key.alias("id"), F.lit("pending").alias("status"), F.when(key % 2 == 0, "old error").alias("error"), F.concat(F.lit("audio"), key.cast("string")).alias("audio"))
    log = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    log = log.select(F.col("user_id").alias("id"), "ts", "event_id", F.when(kind == "click", "done").when(kind == "view", "").otherwise(kind).alias("status"), (kind != "error").alias("has_status"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error"), (kind == "error").alias("has_error"))
    last = S.last_by_key(log, ["id"], ["ts", "event_id"])
    return S.merge_status(queue, last, "id", ["status", "error"], F.col("status") == "done", "error")


@register("status_counts", "SELECT count(*) FILTER (event_type = 'click') AS done, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type NOT IN ('click', 'error')) AS pending, count(DISTINCT user_id) AS episodes FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = status_last_wins(spark, sf_dir)
    kind = F.col("status")
    return last.agg(F.count_if(kind == "click").alias("done"), F.count_if(kind == "error").alias("errors"), F.count_if(~kind.isin("click", "error")).alias("pending"), F.count_distinct("user_id").alias("episodes"))


@register(
    "upsert_preserve",
    "SELECT n.c_custkey, coalesce(nullif(o.c_name, ''), n.c_name) AS c_name, coalesce(nullif(o.c_mktsegment, ''), n.c_mktsegment) AS c_mktsegment, n.c_acctbal FROM (SELECT c_custkey, c_name || '*' AS c_name, 'NEW' AS c_mktsegment, c_acctbal FROM customer) n LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS c_name, c_mktsegment FROM customer WHERE c_custkey % 5 <> 0) o ON n.c_custkey = o.c_custkey",
)
def upsert_preserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    new = customers.withColumns({"c_name": F.concat("c_name", F.lit("*")), "c_mktsegment": F.lit("NEW")})
    old = customers.where("c_custkey % 5 <> 0").withColumn("c_name", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")))
    return S.upsert_preserving(new, old, "c_custkey", ["c_name", "c_mktsegment"])


@register(
    "upsert_new_wins",
    "SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.has_name THEN n.c_name ELSE o.c_name END AS c_name, o.c_mktsegment FROM (SELECT * FROM customer WHERE c_custkey % 5 <> 0) o FULL JOIN (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || '+' WHEN c_custkey % 7 = 0 THEN '' END AS c_name, c_custkey % 4 <> 1 AS has_name FROM customer WHERE c_custkey % 3 = 0) n ON o.c_custkey = n.c_custkey",
)
def upsert_new_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New values win where they are given, null and empty ones too; one new row in four gives no name."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    new = customers.where(k % 3 == 0).select("c_custkey", F.when(k % 2 == 0, F.concat("c_name", F.lit("+"))).when(k % 7 == 0, "").alias("c_name"), (k % 4 != 1).alias("has_c_name"))
    return S.upsert_new_wins(new, customers.where("c_custkey % 5 <> 0"), "c_custkey")


@register(
    "recording_status",
    """WITH p AS (SELECT user_id, event_type AS status FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60) THEN 'done' WHEN p.status IN ('error', 'running') THEN p.status
 WHEN c_custkey % 5 = 0 THEN 'missing_audio' ELSE 'pending' END AS status FROM customer LEFT JOIN p ON c_custkey = p.user_id""",
)
def recording_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each item of a manifest stands: by its transcript, what its last run said, and whether it has an address."""
    events = table(spark, sf_dir, "events")
    last = S.last_by_key(events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("previous"))
    texts = events.where("event_type = 'purchase' and value > 60").select(F.col("user_id").alias("c_custkey"), F.lit(True).alias("transcribed")).distinct()
    rows = table(spark, sf_dir, "customer").select("c_custkey").join(last, "c_custkey", "left").join(texts, "c_custkey", "left")
    audio = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("audio"), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 2 == 0, "")
    return rows.select("c_custkey", S.recording_status(F.coalesce("transcribed", F.lit(False)), F.coalesce("previous", F.lit("")), audio).alias("status"))


@register(
    "queue_newest_first",
    "SELECT event_id, user_id, day FROM (SELECT event_id, user_id, value, event_type, CASE WHEN event_id % 9 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events) WHERE event_id % 2 = 0 AND value > 20 AND event_type <> 'error' ORDER BY coalesce(day, '') DESC, event_id LIMIT 100",
)
def queue_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 100 of a worker's share, newest first; rows of one day in the queue's order, rows without a day last."""
    queue = table(spark, sf_dir, "events").withColumn("day", F.when(F.col("event_id") % 9 != 0, F.date_format("ts", "yyyy-MM-dd")))
    nothing = queue.where("false").select("user_id")
    return S.pending(queue, "event_id", 2, 0, (F.col("value") > 20) & (F.col("event_type") != "error"), nothing, "user_id", F.col("day"), 100).select("event_id", "user_id", "day")


@register(
    "feed_newest_first",
    "SELECT event_id, stamp, row_number() OVER (ORDER BY coalesce(stamp, '') DESC, event_id) AS place FROM (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS stamp FROM events)",
)
def feed_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of a feed, newest first, with their place; items without a time are the oldest."""
    items = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("stamp"))
    return S.placed(items, S.newest_first(F.col("stamp"), F.col("event_id")))


@register("feed_totals", "SELECT source AS feed, count(*) AS parsed, count(*) FILTER (n_chars >= 400) AS kept, sum(n_chars)::BIGINT AS chars, arg_max(doc_id, (n_chars, -doc_id)) AS latest FROM documents GROUP BY source UNION ALL SELECT 'all', count(*), count(*) FILTER (n_chars >= 400), sum(n_chars)::BIGINT, arg_max(doc_id, (n_chars, -doc_id)) FROM documents")
def feed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each feed and of all; sources stand for feeds, lengths for times."""
    sums = [F.count(F.lit(1)).alias("parsed"), F.count_if(F.col("n_chars") >= 400).alias("kept"), F.sum("n_chars").alias("chars"), F.max_by("doc_id", F.struct("n_chars", F.negate("doc_id"))).alias("latest")]
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.col("source").alias("feed")).agg(*sums).unionByName(docs.agg(*sums).select(F.lit("all").alias("feed"), "*"))


@register("full_recordings", "SELECT event_id, NOT (contains(lower(title), '#view') OR contains(lower(title), 'err')) AND user_id >= 40 AS is_full FROM (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN '#' || upper(event_type) ELSE event_type END AS title FROM events)")
def full_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("#"), F.upper("event_type"))).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", S.full_recording(title, F.col("user_id"), 40, ("#view", "err")).alias("is_full"))


@register(
    "flagged_rows",
    "SELECT doc_id, lang = 'fr' OR starts_with(doc_id::VARCHAR, '77') OR contains(lower(concat_ws(' ', source, lang)), 'src4') OR contains(text, 'Eau') OR contains(text, 'Tion') AS included FROM documents",
)
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that belong by any of several signs: a flag, the form of their id, a word in short fields, a name in their text."""
    found = S.any_flag([F.col("lang") == "fr"], [F.upper("source"), F.col("lang")], [F.col("text")], F.col("doc_id").cast("string"), "src4", ("Eau", "Tion"), "77")
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("included"))


@register("any_term", "SELECT page_id, contains(html, 'src=') OR contains(html, 'Shop') OR contains(url, '/en/') AS relevant FROM (SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url FROM pages)")
def any_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that have any of the terms in their address or text."""
    return table(spark, sf_dir, "pages").select("page_id", Q.any_term(F.concat_ws("\n", "url", "html"), ("src=", "Shop", "/en/")).alias("relevant"))


@register(
    "daily_gate",
    """WITH d AS (SELECT max(ts::DATE) AS today FROM events), r AS (SELECT ts::DATE AS checked_date FROM events WHERE event_type = 'error'),
f AS (SELECT (SELECT count(*) FROM r, d WHERE checked_date = today) > 0 AS checked, (SELECT count(*) FROM documents WHERE n_chars < 0) > 0 AS changed, (SELECT count(*) FROM events WHERE value > 99) > 0 AS waiting)
SELECT NOT checked OR changed OR waiting AS due, CASE WHEN NOT checked THEN 'not_checked_today' WHEN changed THEN 'sources_changed' WHEN waiting THEN 'targets_waiting' ELSE 'already_checked' END AS reason FROM f""",
)
def daily_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether today's run has work; error events stand for noted runs, the last day of the events for today."""
    events = table(spark, sf_dir, "events")
    today = events.agg(F.max(F.to_date("ts"))).first()[0]
    runs = events.where("event_type = 'error'").select(F.to_date("ts").alias("checked_date"))
    return S.due_today(runs, F.lit(today), table(spark, sf_dir, "documents").where("n_chars < 0"), events.where("value > 99"))


@register(
    "sort_times",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch(date_trunc('second', ts))::BIGINT WHEN 1 THEN epoch(ts::DATE)::BIGINT WHEN 2 THEN 0 ELSE epoch(ts::DATE)::BIGINT END AS t FROM events",
)
def sort_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time to sort by: the first of several fields that can be read, in whole seconds; 0 if none can."""
    k = F.col("event_id") % 4
    stamp = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 3, "soon")
    day = F.when((k == 1) | (k == 3), F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select("event_id", S.sort_time(stamp, day).alias("t"))


@register("upsert_union", "SELECT c_custkey, c_name FROM (SELECT c_custkey, c_name, 0 AS o FROM customer UNION ALL SELECT c_custkey, 'v2 ' || c_name, 1 FROM customer WHERE c_custkey % 4 = 0) QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o DESC) = 1")
def upsert_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(0).alias("o"))
    new = old.where("c_custkey % 4 = 0").select("c_custkey", F.concat(F.lit("v2 "), "c_name").alias("c_name"), F.lit(1).alias("o"))
    return S.last_by_key(old.unionByName(new), ["c_custkey"], ["o"]).drop("o")


@register("reconcile_files", "SELECT doc_id, source, 'listed' AS status FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, 'unknown', 'found' FROM documents WHERE doc_id % 3 = 0")
def reconcile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = docs.where("doc_id % 3 <> 0").select("doc_id", "source", F.lit("listed").alias("status"))
    return S.reconcile(manifest, docs.select("doc_id"), "doc_id", {"source": F.lit("unknown"), "status": F.lit("found")})


@register("pending_shard", "SELECT event_id, user_id FROM events e WHERE event_id % 3 = 1 AND value > 5 AND event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id % 2 = 0)")
def pending_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = table(spark, sf_dir, "events")
    done = queue.where("event_type = 'purchase' and user_id % 2 = 0").select("user_id")
    return S.pending(queue, "event_id", 3, 1, (F.col("value") > 5) & (F.col("event_type") != "error"), done, "user_id").select("event_id", "user_id")


_KEY = "strftime(ts, '%Y-%m-%d') || '|' || regexp_replace(replace(event_type, 'view', ''), '\\s+', '', 'g') || '|' || floor(user_id / 30)::BIGINT"


@register("content_key_dupes", f"SELECT {_KEY} AS content_key, count(*) AS copies, min(event_id) AS first_event FROM events GROUP BY 1 HAVING count(*) > 1")
def content_key_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = S.content_key(F.col("event_type"), F.date_format("ts", "yyyy-MM-dd"), F.col("user_id"), ("view",))
    return table(spark, sf_dir, "events").groupBy(key.alias("content_key")).agg(F.count(F.lit(1)).alias("copies"), F.min("event_id").alias("first_event")).where("copies > 1")


@register(
    "newest_target",
    f"""WITH r AS (SELECT event_id AS id, ts::DATE AS day, ts, user_id % 2 = 0 AS dedicated, user_id AS seconds, user_id >= 20 AS full_, value > 99999 AS done, {_KEY} AS key FROM events),
n AS (SELECT * FROM r WHERE day = (SELECT max(day) FROM r)), f AS (SELECT * FROM n WHERE full_ OR NOT (SELECT bool_or(full_) FROM n)),
k AS (SELECT key FROM f ORDER BY ts DESC, dedicated DESC, seconds DESC, id LIMIT 1), c AS (SELECT * FROM f WHERE key = (SELECT key FROM k))
SELECT id, day, key FROM c WHERE NOT (SELECT bool_or(done) FROM c)""",
)
def newest_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = S.content_key(F.col("event_type"), F.date_format("ts", "yyyy-MM-dd"), F.col("user_id"), ("view",))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.to_date("ts").alias("day"), "ts", (F.col("user_id") % 2 == 0).alias("dedicated"), F.col("user_id").alias("seconds"), (F.col("user_id") >= 20).alias("full"), (F.col("value") > 99999).alias("done"), key.alias("key"))
    return S.newest_target(rows).select("id", "day", "key")


@register("category_names", "SELECT p_partkey, string_agg(coalesce(n_name, i::VARCHAR), ',' ORDER BY pos) AS names FROM (SELECT p_partkey, unnest([p_partkey % 30, p_partkey % 7]) AS i, unnest([0, 1]) AS pos FROM part) LEFT JOIN nation ON n_nationkey = i GROUP BY p_partkey")
def category_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.array(F.col("p_partkey") % 30, F.col("p_partkey") % 7).alias("ids"))
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    return S.names_of(parts, "ids", names, "p_partkey").select("p_partkey", F.array_join("category_names", ",").alias("names"))


@register("first_url_wins", "SELECT source, doc_id FROM (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source)")
def first_url_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_by_key(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id")


@register("key_sets", "SELECT 'only_documents' AS side, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'both', doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_anti").select(F.lit("only_documents").alias("side"), "doc_id").unionByName(docs.join(labels, "doc_id", "left_semi").select(F.lit("both").alias("side"), "doc_id"))


@register("date_parts", f"SELECT doc_id, year(day)::INT AS year, month(day)::INT AS month, strftime(day, '%B') AS month_name, strftime(day, '%b ') || day(day) || ', ' || year(day) AS date_display FROM ({DATED})")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("doc_id", F.year("day").alias("year"), F.month("day").alias("month"), F.date_format("day", "MMMM").alias("month_name"), F.date_format("day", "MMM d, yyyy").alias("date_display"))


@register("access_class", "SELECT source, count(*) FILTER (n_chars > 500) AS full_posts, count(*) AS posts, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source")
def access_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts whose text is long enough to be the whole one."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(F.col("n_chars") > 500).alias("full_posts"), F.count(F.lit(1)).alias("posts"), F.sum("n_chars").alias("chars"))


@register("select_window", f"SELECT doc_id, day FROM (SELECT doc_id, day FROM ({DATED}) WHERE day BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND lang IN ('en', 'fr') ORDER BY day DESC, doc_id DESC LIMIT 40)")
def select_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 40 of a window of days and kinds, oldest first: what a run with a limit works on."""
    rows = dated(spark, sf_dir).where(F.col("day").between("1996-01-01", "1997-12-31") & F.col("lang").isin("en", "fr"))
    return rows.select("doc_id", "day").orderBy(F.desc("day"), F.desc("doc_id")).limit(40).orderBy("day", "doc_id")
