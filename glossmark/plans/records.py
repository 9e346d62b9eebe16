"""Queries over records of other shapes, derived from the tables: frontmatter, transcripts in chunks, notes in envelopes, articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import html as H
from glossmark.functions import jsonld, times
from glossmark.functions import text as T
from glossmark.operators import humor, note_rules, prices
from glossmark.operators import notes as N
from glossmark.operators.sync import first_by_key
from glossmark.plans.tables import table
from glossmark.registry import register


def _k() -> Column:
    return F.col("doc_id")


@register(
    "frontmatter_fields",
    "SELECT doc_id, source AS title, '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS date, lang, length(text)::BIGINT AS body_chars FROM documents",
)
def frontmatter_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Markdown files with frontmatter, read again: quotes go, of a repeated key the last line counts, the body stays whole."""
    day = F.concat(F.lit("2024-01-"), F.lpad((_k() % 28 + 1).cast("string"), 2, "0"))
    front = F.concat(F.lit('---\ntitle: first\ndate: "'), day, F.lit('"\nlang: \''), F.col("lang"), F.lit("'\ntitle: "), F.col("source"), F.lit("\n---\n"))
    files = table(spark, sf_dir, "documents").select("doc_id", F.concat(front, F.lit("|"), F.col("text")).alias("raw"))
    fields = T.frontmatter_map(F.col("raw"))
    return files.select("doc_id", fields["title"].alias("title"), fields["date"].alias("date"), fields["lang"].alias("lang"), (F.length(T.strip_frontmatter(F.col("raw"))) - 1).cast("long").alias("body_chars"))


@register("transcript_chunks", "SELECT conv_id, turn AS ord, lpad(turn::VARCHAR, 2, '0') || ':30' AS timestamp, role AS heading, text AS body, turn * 60 + 30 AS seconds FROM conversations")
def transcript_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts, one heading a turn, cut at their headings again."""
    turns = table(spark, sf_dir, "conversations").withColumn("part", F.concat(F.lit("# "), F.lpad(F.col("turn").cast("string"), 2, "0"), F.lit(":30 "), F.col("role"), F.lit("\n"), F.col("text")))
    whole = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "part"))), lambda x: x["part"]), "\n").alias("text"))
    found = humor.chunks_of(whole, "conv_id")
    return found.select("conv_id", "ord", "timestamp", "heading", "body", times.minute_mark_seconds(F.col("timestamp")).alias("seconds"))


@register(
    "note_bullets",
    """WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, '. '), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '' AND x <> '-') AS lines FROM (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents))
SELECT doc_id, len(lines)::INT AS bullets, array_to_string(lines, '|') AS lines, 'Title ' || source AS title FROM s JOIN documents USING (doc_id)""",
)
def note_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bullets of one section of notes, and the notes' title: sentences stand for bullets."""
    bullets = F.array_join(F.transform(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), r"\. "), lambda x: F.concat(F.lit("- "), x)), "\n")
    raw = F.concat(F.lit("---\ndate: x\n---\n# Summary\n# Title "), F.col("source"), F.lit("\nintro\n# Notes\n"), bullets, F.lit("\n-\n\n# Next\n- other"))
    rows = table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))
    lines = T.bullet_lines(T.section(F.col("raw"), "Notes"))
    return rows.select("doc_id", F.size(lines).alias("bullets"), F.array_join(lines, "|").alias("lines"), T.heading_title(F.col("raw"), ["Summary"]).alias("title"))


@register(
    "source_ids",
    "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN source || '-' || doc_id WHEN doc_id % 5 = 1 THEN 'EP' || CASE WHEN doc_id < 1000 THEN lpad(doc_id::VARCHAR, 3, '0') ELSE doc_id::VARCHAR END WHEN doc_id % 5 = 2 THEN 'n' || doc_id ELSE 'note-' || doc_id END AS source_id FROM documents",
)
def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of records that name themselves in different fields, or not at all."""
    text = _k().cast("string")
    named, number = F.when(_k() % 5 == 0, F.concat("source", F.lit("-"), text)), F.when(_k() % 5 == 1, text).when(_k() % 5 == 2, F.concat(F.lit("n"), text))
    return table(spark, sf_dir, "documents").select("doc_id", T.source_id([F.lit(""), named], [number], "note", text).alias("source_id"))


@register("symbol_slugs", "SELECT DISTINCT o_orderpriority AS symbol, regexp_replace('INDEX_' || o_orderpriority, '[^A-Za-z0-9._-]+', '_', 'g') AS slug, replace(regexp_replace('INDEX_' || o_orderpriority, '[^A-Za-z0-9._-]+', '_', 'g'), 'INDEX_', '^') AS again FROM orders")
def symbol_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of symbols, and what is left of the symbol in them."""
    slug = prices.symbol_slug(F.concat(F.lit("^"), F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("symbol"), slug.alias("slug"), prices.slug_symbol(slug).alias("again")).distinct()


@register(
    "publication_times",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN date_trunc('second', ts) + INTERVAL 8 HOUR WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts) + INTERVAL 8 HOUR WHEN 4 THEN date_trunc('minute', ts) END AS published,
 CASE event_id % 6 WHEN 5 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS written FROM events""",
)
def publication_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of publication in six shapes as local wall time, and the date that the text itself has."""
    k = F.col("event_id") % 6
    ts = F.col("ts")
    shown = (
        F.when(k == 0, F.unix_seconds(ts.cast("timestamp")).cast("string"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd"))
        .when(k == 2, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .when(k == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 4, F.date_format(ts, "yyyy-MM-dd HH:mm"))
        .otherwise("soon")
    )
    day = F.when(k == 0, F.date_format(ts, "'on 'yyyy/M/d")).otherwise(shown)
    return table(spark, sf_dir, "events").select("event_id", times.published_local(shown).alias("published"), times.date_in(day).alias("written"))


@register(
    "strict_dates",
    "SELECT event_id, CASE WHEN event_id % 4 IN (0, 3) THEN ts::DATE END AS day, CASE WHEN event_id % 4 IN (0, 3) THEN strftime(ts, '%Y-%m-%d') END AS of_path FROM events",
)
def strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO dates and nothing near them; and the date in a file's name."""
    k, ts = F.col("event_id") % 4, F.col("ts")
    shown = F.when(k == 1, F.date_format(ts, "yyyy/MM/dd")).when(k == 2, "2024-13-45x").otherwise(F.date_format(ts, "yyyy-MM-dd"))
    path = F.concat(F.lit("/a/2020-01-01/"), F.when(k.isin(0, 3), F.concat(shown, F.lit("_x.md"))).otherwise("x.md"))
    return table(spark, sf_dir, "events").select("event_id", times.strict_date(shown).alias("day"), times.path_date(path).alias("of_path"))


@register("humor_signal", "SELECT conv_id, turn, contains(text, 'joke') OR contains(text, 'que ') OR contains(text, 'eau') OR contains(text, 'ing') OR regexp_matches(text, 'la.*der|ou la') AS signal, CASE WHEN regexp_matches(text, 'tion') THEN 'direct' WHEN regexp_matches(text, 'sch|ung') THEN 'analogy' ELSE 'weak' END AS relevance FROM conversations")
def humor_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a passage may be a joke, by its markers or else a pattern, and how near it is to the subject."""
    text = F.col("text")
    found = humor.signal(text, humor.Markers(explicit=("joke", "que "), strong=("eau", "ing")), "la.*der|ou la")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", found.alias("signal"), humor.first_class(text, {"direct": "tion", "analogy": "sch|ung"}, "weak").alias("relevance"))


def _first_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, note): a note of the first format for each document, as JSON text; some lack fields or have values of no vocabulary."""
    logic = F.struct(
        F.lit("c").alias("claim"), F.lit("t").alias("trigger"), F.element_at(F.array(*map(F.lit, ("buy", "jump", "hold", "Trim"))), (_k() % 4 + 1).cast("int")).alias("action_bias"),
        F.lit("r").alias("risk_control"), F.col("text").alias("evidence"), F.when(_k() % 3 == 0, "maybe").otherwise("low").alias("confidence"),
    )
    seen = F.struct(
        F.col("source").alias("asset_or_sector"), F.when(F.col("lang") == "en", "bullish").otherwise("sideways").alias("view"), F.lit("swing").alias("time_horizon"),
        F.lit("r").alias("reasoning"), F.lit("m").alias("market_alignment"), F.when(_k() % 6 != 0, _k() % 2 == 0).alias("is_joke_or_aside"),
    )
    nothing = F.array().cast("array<string>")
    note = F.struct(
        F.when(_k() % 7 != 0, _k()).alias("episode"), F.lit("2024-01-01").alias("date"), F.col("source").alias("title"), F.lit("x").alias("market_regime"),
        F.array_repeat(F.lit("t"), (_k() % 10).cast("int")).alias("topics"), F.array(logic).alias("investment_logic"), F.array(seen).alias("trade_observations"), nothing.alias("qa_views"), nothing.alias("open_questions"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.to_json(note).alias("note"))


_FIRST_ERRORS = """CASE WHEN doc_id % 7 = 0 THEN 'missing episode' ELSE concat_ws('; ', CASE WHEN doc_id % 10 NOT BETWEEN 3 AND 8 THEN 'topics must contain 3-8 items' END,
 CASE doc_id % 4 WHEN 1 THEN 'investment_logic[0].action_bias invalid: jump' WHEN 3 THEN 'investment_logic[0].action_bias invalid: Trim' END, CASE WHEN doc_id % 3 = 0 THEN 'investment_logic[0].confidence invalid: maybe' END,
 CASE WHEN length(text) > 200 THEN 'investment_logic[0].evidence exceeds 200 chars' END, CASE WHEN doc_id % 6 = 0 THEN 'trade_observations[0] missing is_joke_or_aside' END,
 CASE WHEN lang IS DISTINCT FROM 'en' THEN 'trade_observations[0].view invalid: sideways' END, CASE WHEN doc_id % 6 = 0 THEN 'trade_observations[0].is_joke_or_aside must be bool' END) END"""


@register("note_errors_first", f"SELECT doc_id, {_FIRST_ERRORS} AS errors FROM documents")
def note_errors_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with notes of the first format."""
    return _first_notes(spark, sf_dir).select("doc_id", F.array_join(note_rules.validate(F.try_parse_json("note"), note_rules.FIRST_FORMAT), "; ").alias("errors"))


@register(
    "note_repaired",
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE doc_id END::INT AS episode, CASE doc_id % 4 WHEN 0 THEN 'buy' WHEN 1 THEN 'unknown' WHEN 2 THEN 'hold' ELSE 'size-down' END AS action, CASE WHEN doc_id % 3 = 0 THEN 'medium' ELSE 'low' END AS confidence,
 CASE WHEN lang = 'en' THEN 'bullish' ELSE 'neutral' END AS view, CASE WHEN doc_id % 6 <> 0 THEN doc_id % 2 = 0 ELSE false END AS joke,
 CASE WHEN length(t) > 200 THEN substr(t, 1, 197) || '...' ELSE t END AS evidence FROM (SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents)""",
)
def note_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same notes brought to their vocabularies, fields they lack from metadata."""
    note = note_rules.repaired(F.from_json("note", note_rules.FIRST_SCHEMA), F.lit(-1), F.lit(""), F.col("source"))
    rows = _first_notes(spark, sf_dir).select("doc_id", note.alias("n"))
    logic, seen = F.col("n.investment_logic")[0], F.col("n.trade_observations")[0]
    return rows.select("doc_id", F.col("n.episode").alias("episode"), logic["action_bias"].alias("action"), logic["confidence"].alias("confidence"), seen["view"].alias("view"), seen["is_joke_or_aside"].alias("joke"), logic["evidence"].alias("evidence"))


def enveloped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, record): the notes as batch services hand them back, in five shapes, one of them without a note."""
    n = F.col("note")
    inner = F.to_json(F.struct(n.alias("x")))
    quoted = F.substring(inner, F.lit(6), F.length(inner) - 6)  # the note as a JSON string
    fenced = F.to_json(F.struct(F.concat(F.lit("```json\n"), n, F.lit("\n```")).alias("x")))
    fenced = F.substring(fenced, F.lit(6), F.length(fenced) - 6)
    shape = F.when(_k() % 5 == 0, n).when(_k() % 5 == 1, F.concat(F.lit('{"content": '), n, F.lit("}"))).when(_k() % 5 == 2, F.concat(F.lit('{"response": {"output_text": '), fenced, F.lit("}}")))
    shape = shape.when(_k() % 5 == 3, F.concat(F.lit('{"body": {"choices": [{"message": {"content": '), quoted, F.lit("}}]}}"))).otherwise('{"error": "none"}')
    return _first_notes(spark, sf_dir).select("doc_id", "source", shape.alias("record"))


@register("note_located", "SELECT doc_id, CASE WHEN doc_id % 5 = 4 OR doc_id % 35 = 0 THEN NULL ELSE source END AS title, CASE WHEN doc_id % 5 = 4 OR doc_id % 35 = 0 THEN NULL ELSE length(text) END::INT AS evidence_chars FROM documents")
def note_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The note in each envelope; a bare one counts as a note if it has topics and an episode."""
    rows = enveloped(spark, sf_dir).select("doc_id", note_rules.located(F.try_parse_json("record")).alias("n"))
    return rows.select("doc_id", F.try_variant_get("n", "$.title", "string").alias("title"), F.length(F.try_variant_get("n", "$.investment_logic[0].evidence", "string")).alias("evidence_chars"))


@register(
    "note_batches",
    """WITH a AS (SELECT doc_id, 0 AS attempt, doc_id % 5 <> 4 AND doc_id % 35 <> 0 AND doc_id % 7 <> 0 AND doc_id % 10 BETWEEN 3 AND 8 AS valid FROM documents UNION ALL SELECT doc_id, 1, doc_id % 2 = 0 FROM documents WHERE doc_id % 3 = 0)
SELECT doc_id, attempt, valid FROM a QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY valid DESC, attempt DESC) = 1""",
)
def note_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of two runs settled: located, repaired, checked; the last valid output of a note stands, without one its last error."""
    located = enveloped(spark, sf_dir).select("doc_id", "source", F.to_json(note_rules.located(F.try_parse_json("record"))).alias("note"))
    fixed = note_rules.repaired(F.from_json("note", note_rules.FIRST_SCHEMA), F.lit(None).cast("int"), F.lit(""), F.col("source"))
    # flags are booleans again after the repair, which the schema reads as text
    checked = located.select("doc_id", F.lit(0).alias("attempt"), F.when(F.col("note").isNotNull(), F.to_json(fixed)).alias("note"))
    errors = note_rules.validate(F.try_parse_json("note"), note_rules.FIRST_FORMAT)
    first = checked.select("doc_id", "attempt", (F.size(errors) == 0).alias("valid"))
    again = table(spark, sf_dir, "documents").where(_k() % 3 == 0).select("doc_id", F.lit(1).alias("attempt"), (_k() % 2 == 0).alias("valid"))
    return N.settle_batches(first.unionByName(again), "doc_id", ["attempt"], "valid")


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): the pages, four of five with a JSON-LD article in a graph."""
    k = F.col("page_id")
    author = F.when(k % 3 == 0, F.lit('[{"@type": "Person", "name": "A  B"}, "C"]')).when(k % 3 == 1, F.lit('{"@id": "person-1"}')).otherwise(F.lit('"D"'))
    words = F.when(k % 2 == 0, F.lit('["x", "y"]')).otherwise(F.lit('"x, y,"'))
    ld = F.concat(F.lit('<script type="application/ld+json">{"@graph": [{"@type": "Person"}, {"@type": ["NewsArticle"], "headline": "News\t'), k.cast("string"), F.lit('", "mainEntityOfPage": {"@id": "https://n/'), k.cast("string"), F.lit('"}, "author": '), author, F.lit(', "keywords": '), words, F.lit(', "image": [{"url": "i.png"}], "isAccessibleForFree": true}]}</script>'))
    meta = F.lit('<meta content="From meta" property="og:title"><meta name="author" content="M">')
    html = F.concat(F.when(k % 5 != 0, ld).otherwise(meta), F.coalesce("html", F.lit("")))
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


_ARTICLES = """SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN 'News ' || page_id ELSE 'From meta' END AS title, CASE WHEN page_id % 5 <> 0 THEN 'https://n/' || page_id END AS article_url,
 CASE WHEN page_id % 5 = 0 THEN 'M' WHEN page_id % 3 = 0 THEN 'A B, C' WHEN page_id % 3 = 1 THEN 'person-1' ELSE 'D' END AS author, CASE WHEN page_id % 5 <> 0 THEN 'x|y' END AS keywords, CASE WHEN page_id % 5 <> 0 THEN 'i.png' END AS image_url, CASE WHEN page_id % 5 <> 0 THEN 'true' END AS free FROM pages"""


def _metadata(pages: DataFrame) -> DataFrame:
    found = pages.select("page_id", "url", "html", jsonld.article(F.col("html")).alias("a"))
    return found.select("page_id", "url", "html", "a.title", F.col("a.url").alias("article_url"), "a.author", F.array_join("a.keywords", "|").alias("keywords"), "a.image_url", F.col("a.is_accessible_for_free").alias("free"))


@register("article_metadata", _ARTICLES)
def article_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of articles by JSON-LD at any depth, repaired where tabs break it, else by meta tags."""
    return _metadata(article_pages(spark, sf_dir)).drop("url", "html")


_BODY = r"regexp_extract(coalesce(html, ''), '(?is)<article\b[^>]*>(.*?)</article>', 1)"


@register(
    "article_crawl",
    f"""WITH p AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1), m AS ({_ARTICLES})
SELECT page_id, url, title, author, length({_BODY})::INT AS body_chars, contains(concat_ws(chr(10), title, author, {_BODY}), 'News 1') OR contains(concat_ws(chr(10), title, author, {_BODY}), 'tion') AS relevant FROM p JOIN m USING (page_id)""",
)
def article_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl as one job, offline: of each address the first page, its metadata and body, and whether it has any of the terms."""
    return article_records(article_pages(spark, sf_dir), ("News 1", "tion")).select("page_id", "url", "title", "author", F.length("body").alias("body_chars"), "relevant")


def article_records(pages: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """pages (page_id, url, html) as articles with body (HTML) and relevant; functions.html.html_to_markdown makes the text to keep."""
    from glossmark.operators.search import any_term

    first = first_by_key(pages, "url", "page_id")
    found = _metadata(first).withColumn("body", H.article_body(F.col("html")))
    return found.withColumn("relevant", any_term(F.concat_ws("\n", "title", "author", "body"), terms)).drop("html")


def column_subset(rows: DataFrame, names: list[str]) -> DataFrame:
    """The concise view of a record: those of names that it has, in their order."""
    return rows.select(*[n for n in names if n in rows.columns])


def market_subset(markets: Column, symbols: tuple[str, ...]) -> Column:
    """Of a map of symbols to their snapshots, those that are asked for."""
    return F.map_filter(markets, lambda k, _: k.isin(*symbols))


@register(
    "market_subset",
    "SELECT d, string_agg(symbol || '=' || printf('%.2f', close), ';' ORDER BY symbol) AS shown FROM (SELECT o_orderdate::DATE AS d, o_orderpriority AS symbol, max(o_totalprice) AS close FROM orders GROUP BY ALL) WHERE symbol IN ('1-URGENT', '3-MEDIUM') GROUP BY d",
)
def market_subset_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's market map cut to two symbols."""
    from glossmark.plans.tables import bars

    days = bars(spark, sf_dir).groupBy("d").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "close")))).alias("markets"))
    shown = F.transform(F.map_entries(market_subset(F.col("markets"), ("1-URGENT", "3-MEDIUM"))), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.2f", e["value"])))
    return column_subset(days.select("d", F.array_join(shown, ";").alias("shown"), "markets"), ["d", "shown", "none"]).where("shown <> ''")
