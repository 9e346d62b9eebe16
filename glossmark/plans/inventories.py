"""Queries over inventories and feeds derived from the tables: article records, gates on their paths, hashtags, session closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import jsonld, times
from glossmark.functions import text as T
from glossmark.operators import prices
from glossmark.operators.sync import allowed_only
from glossmark.plans.market import SNAP
from glossmark.plans.records import article_pages
from glossmark.plans.tables import bars, table
from glossmark.registry import register
from glossmark.sources import files

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FEED = "replace(replace(text, 'e ', 'e #'), '. ', '，')"


def _distinct(words: str) -> str:
    return f"array_to_string(list_filter({words}, lambda x, i: x <> '' AND list_position({words}, x) = i), '|')"


@register(
    "feed_tags",
    f"""SELECT doc_id, {_distinct("tags")} AS tags, {_distinct("words")} AS keywords FROM (SELECT doc_id, regexp_extract_all(feed, '#([^\\s#，,、]+)', 1) AS tags,
 list_transform(regexp_split_to_array(feed, '[,，\\n\\t]+'), lambda x: trim(trim(x, {_WHITE}), '#')) AS words FROM (SELECT doc_id, coalesce({_FEED}, '') AS feed FROM documents))""",
)
def feed_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashtags and keywords of a feed's descriptions, each once and in order: documents whose words are tagged here and there."""
    feed = F.replace(F.replace(F.col("text"), F.lit("e "), F.lit("e #")), F.lit(". "), F.lit("，"))
    rows = table(spark, sf_dir, "documents").select("doc_id", feed.alias("feed"))
    return rows.select("doc_id", F.array_join(T.hashtags(F.col("feed")), "|").alias("tags"), F.array_join(T.split_keywords(F.col("feed")), "|").alias("keywords"))


@register(
    "frontmatter_loose",
    f"""SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN source END AS title, CASE WHEN doc_id % 3 <> 0 THEN '''' || lang || '''' END AS lang,
 CASE WHEN doc_id % 3 = 0 THEN length(text) + 3 ELSE length(trim(text, {_WHITE})) END::BIGINT AS body_chars FROM documents""",
)
def frontmatter_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontmatter that ends at the next mark wherever it stands: single quotes stay, the body is stripped; a third of the documents begins otherwise."""
    front = F.concat(F.lit('---\ntitle: "'), F.col("source"), F.lit("\"\nno field\nlang: '"), F.col("lang"), F.lit("'\n---\n\n"))
    raw = F.concat(F.when(F.col("doc_id") % 3 == 0, "---").otherwise(front), F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", T.frontmatter_parts(raw).alias("p"))
    return rows.select("doc_id", F.col("p.meta")["title"].alias("title"), F.col("p.meta")["lang"].alias("lang"), F.length("p.body").cast("long").alias("body_chars"))


_BASE = "https://n"


def article_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, source, source_list_url, ... of the fifteen fields): the records of the pages' articles, ten to a list page."""
    k = F.col("page_id")
    found = article_pages(spark, sf_dir).select("page_id", jsonld.article(F.col("html")).alias("a"))
    listed = F.concat(F.lit("https://n/list/"), F.floor(k / 10).cast("string"))
    return found.select("page_id", jsonld.record(F.col("a"), F.lit("pages"), listed, (k % 10).cast("int"), _BASE).alias("r")).select("page_id", "r.*")


_RECORDS = """SELECT page_id, 'pages' AS source, 'https://n/list/' || page_id // 10 AS source_list_url, (page_id % 10)::INT AS list_position, CASE WHEN page_id % 5 <> 0 THEN page_id::VARCHAR ELSE 'https-n' END AS article_id,
 CASE WHEN page_id % 5 <> 0 THEN 'https://n/' || page_id ELSE 'https://n' END AS url, CASE WHEN page_id % 5 <> 0 THEN 'News ' || page_id ELSE 'From meta' END AS title FROM pages"""


@register("article_records", _RECORDS)
def article_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as an inventory keeps them: where they were found, an address made whole, an id."""
    return article_rows(spark, sf_dir).select("page_id", "source", "source_list_url", "list_position", "article_id", "url", "title")


@register(
    "article_inventory",
    f"SELECT 'article' AS kind, '' AS date, article_id AS id, title, 'articles.jsonl' AS path, trim(title || ' ' || article_id) AS text FROM ({_RECORDS})",
)
def article_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as rows to search."""
    return files.article_inventory(article_rows(spark, sf_dir), "articles.jsonl")


@register(
    "joke_inventory",
    "SELECT 'joke' AS kind, '' AS date, 'jokes.jsonl' AS path, turn::VARCHAR AS timestamp, role AS confidence, coalesce(text, '') AS text FROM conversations WHERE contains(text, 'joke') OR turn % 5 = 0",
)
def joke_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jokes as rows to search; turns of conversations stand for them."""
    turns = table(spark, sf_dir, "conversations").where(F.contains("text", F.lit("joke")) | (F.col("turn") % 5 == 0))
    return files.joke_inventory(turns.select(F.col("turn").alias("timestamp"), F.col("role").alias("confidence"), F.col("text").alias("text_preview")), "jokes.jsonl")


@register(
    "article_gate",
    "SELECT doc_id, 'articles/' || source || '-' || doc_id || '.md' AS path FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE doc_id % 4 <> 0)",
)
def article_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article files that the inventory has: documents as files; the labelled ones have a row in the inventory, of which every fourth names no file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("articles/"), F.col("source"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"))
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select(F.when(F.col("doc_id") % 4 != 0, F.col("path")).otherwise("").alias("path"))
    return allowed_only(docs, labelled).select("doc_id", "path")


@register(
    "session_alignment",
    f"""WITH snap AS ({SNAP}), e AS (SELECT event_id, ts - INTERVAL 10000 DAY AS ts FROM events),
t AS (SELECT event_id, CASE WHEN ts::TIME >= TIME '13:35:00' THEN ts::DATE ELSE ts::DATE - 1 END AS target, CASE WHEN ts::TIME >= TIME '13:35:00' THEN 'same_day_close' ELSE 'prior_close' END AS label, symbol FROM e, (SELECT DISTINCT symbol FROM snap))
SELECT event_id, target, label, t.symbol, d, close, ret_20d_pct, drawdown_60d_pct FROM t ASOF LEFT JOIN snap s ON t.symbol = s.symbol AND t.target >= s.d""",
)
def session_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications with the last close that was known: from the session's end on the day's own, before it that of the day before."""
    day, label = times.market_target(F.col("ts") - F.expr("INTERVAL '10000' DAY"))
    rows = table(spark, sf_dir, "events").select("event_id", day.alias("target"), label.alias("label"))
    found = prices.as_of_days(rows, prices.with_returns(bars(spark, sf_dir)))
    return found.select("event_id", "target", "label", "symbol", "d", "close", "ret_20d_pct", "drawdown_60d_pct")
