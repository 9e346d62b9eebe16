"""Files as tables: JSON and JSONL in their strictnesses, Markdown corpora, feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import text as T
from glossmark.functions import times
from glossmark.operators.sync import last_by_key


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """A row a line. Strict: a line that isn't an object of the schema fails the read; else it is left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of the lines that aren't JSON objects, blank ones aside: what a permissive read leaves out."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    kind = F.schema_of_variant(F.try_parse_json("line"))
    return lines.where((F.trim("line") != "") & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)))


def read_keyed(spark: SparkSession, path: str, schema: str, key: str, ord_: str) -> DataFrame:
    """The last row of each key, by ord."""
    return last_by_key(read_jsonl(spark, path, schema), [key], [ord_])


def read_corpus(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(kind, path, file, date, front, raw, text) of a folder of Markdown files; the date is in the frontmatter, or else in the name."""
    files = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", True).text(path, wholetext=True)
    rows = files.select(F.lit(kind).alias("kind"), F.col("_metadata.file_path").alias("path"), F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("file"), F.col("value").alias("raw"))
    rows = rows.withColumn("front", T.frontmatter_map(F.col("raw")))
    stem = F.regexp_replace("file", r"\.md$", "")
    named = F.regexp_extract("file", r"\d{4}-\d{2}-\d{2}", 0)
    date = F.coalesce(F.nullif(times.date_string(F.col("front")["date"]), F.lit("")), F.nullif(named, F.lit("")), stem)
    return rows.withColumns({"date": date, "text": T.plain_markdown(F.col("raw"))})


def corpus_union(*corpora: DataFrame) -> DataFrame:
    """Kinds as one table; columns that a kind lacks are null."""
    first, *rest = corpora
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def via_manifest(manifest: DataFrame, corpus: DataFrame, local_path: str = "local_path") -> DataFrame:
    """Manifest rows with the text of the file they name."""
    return manifest.join(corpus.select(F.col("file").alias(local_path), "text"), local_path)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files: title, description as text, publication in UTC and on the local day, audio, length in seconds, a stable id."""
    schema = "title string, description string, pubDate string, guid string, link string, duration string, keywords string, enclosure struct<_url: string, _length: long, _type: string>"
    items = spark.read.format("xml").option("rowTag", "item").option("ignoreNamespace", True).schema(schema).load(path)
    when = times.feed_time(F.col("pubDate"))
    local = F.date_format(F.from_utc_timestamp(when, times.ZONE), "yyyy-MM-dd")
    guid = F.trim(F.coalesce("guid", F.lit("")))
    tail = F.when(guid != "", F.substring(F.regexp_replace(guid, r"[^0-9A-Za-z]+", ""), 1, 12)).otherwise(F.substring(F.sha1(F.coalesce("title", F.lit(""))), 1, 12))
    return items.select(
        F.concat_ws("-", F.coalesce(local, F.lit("undated")), tail).alias("episode_id"),
        T.collapse_spaces(F.col("title")).alias("title"),
        T.collapse_spaces(F.regexp_replace(F.coalesce("description", F.lit("")), r"<[^>]*>", " ")).alias("description_text"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("pub_date_utc"),
        local.alias("local_date"),
        guid.alias("guid"),
        F.col("enclosure._url").alias("audio_url"),
        times.duration_seconds(F.col("duration")).alias("duration_seconds"),
        F.array_distinct(F.filter(F.transform(F.split(F.coalesce("keywords", F.lit("")), "[,，、]"), lambda k: F.trim(k)), lambda k: k != "")).alias("keywords"),
    )


def read_video_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom files, with the chapters their description lists."""
    schema = "videoId string, title string, published string, updated string, link struct<_href: string>, group struct<description: string, thumbnail: struct<_url: string>>"
    entries = spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", True).schema(schema).load(path)
    text = F.coalesce("group.description", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^\s*(\d{1,2}:)?\d{1,2}:\d{2}\s+\S"))
    chapters = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"((?:\d{1,2}:)?\d{1,2}:\d{2})", 1).alias("at"), F.trim(F.regexp_extract(x, r"(?:\d{1,2}:)?\d{1,2}:\d{2}\s+(.*)$", 1)).alias("title")))
    return entries.select(F.col("videoId").alias("video_id"), "title", "published", "updated", F.col("link._href").alias("url"), F.col("group.thumbnail._url").alias("thumbnail"), F.length(text).alias("description_chars"), chapters.alias("chapters"))


def flatten_tree(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """(id, path, depth) of nodes (id, parent, name), level by level from those without a parent: one recursive query, of up to 1,000 levels."""
    return spark.sql(
        """WITH RECURSIVE tree MAX RECURSION LEVEL 1000 AS (
             SELECT id, name AS path, 0 AS depth FROM {nodes} WHERE parent IS NULL
             UNION ALL
             SELECT n.id, concat_ws('/', t.path, n.name), t.depth + 1 FROM tree t JOIN {nodes} n ON n.parent = t.id)
           SELECT id, path, depth FROM tree""",
        nodes=nodes,
    )


def inventory(rows: DataFrame, date_keys: Sequence[str], text_keys: Sequence[str]) -> DataFrame:
    """Metadata rows as searchable text: the first date that is there, the other values in one string."""
    dates = T.first_nonempty(*[F.col(c) for c in date_keys])
    return rows.withColumns({"date": times.date_string(dates), "text": F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in text_keys])})


def _text_of(rows: DataFrame, *names: str) -> list[Column]:
    """Those of the fields that the rows have, as text."""
    return [F.col(n).cast("string") for n in names if n in rows.columns] or [F.lit("")]


def article_inventory(rows: DataFrame, path: str) -> DataFrame:
    """(kind, date, id, title, path, text): an article inventory's rows for search. Fields that it lacks count as empty."""
    # fixed values: where inventories have an article's fields, the first that is there counts
    first = lambda *names: F.coalesce(T.first_nonempty(*_text_of(rows, *names)), F.lit(""))
    title, summary, id_ = first("title"), first("summary", "description"), first("article_id", "id", "url")
    said = F.array_join(F.filter(F.array(title, summary, id_), lambda x: x != ""), " ")
    return rows.select(F.lit("article").alias("kind"), times.date_string(first("date", "published_at", "date_published")).alias("date"), id_.alias("id"), title.alias("title"), F.lit(path).alias("path"), T.plain_markdown(said).alias("text"))


def joke_inventory(rows: DataFrame, path: str) -> DataFrame:
    """(kind, date, path, timestamp, confidence, text): a joke inventory's rows for search; what it lacks is null, but date and text, which are empty."""
    value = lambda name: F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")
    said = lambda name: F.coalesce(value(name), F.lit(""))
    return rows.select(F.lit("joke").alias("kind"), said("date").alias("date"), F.lit(path).alias("path"), value("timestamp").alias("timestamp"), value("confidence").alias("confidence"), said("text_preview").alias("text"))
