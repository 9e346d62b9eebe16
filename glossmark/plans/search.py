"""Queries over text: search, snippets, mentions, shingles, Markdown and HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import html as H
from glossmark.functions import text as T
from glossmark.functions import times
from glossmark.operators import automaton
from glossmark.operators import mentions as M
from glossmark.operators import search as S
from glossmark.plans.tables import DATED, dated, table
from glossmark.registry import oracle_sql, register

TERMS = ["tion", "The", "eau"]


def _score_sql(text: str) -> str:
    return " + ".join(f"((length({text}) - length(replace({text}, '{t.lower()}', ''))) // {len(t)})::BIGINT * {len(t)}" for t in TERMS)


def _snippet_sql() -> str:
    places = ", ".join(f"nullif(strpos(lower(text), '{t.lower()}'), 0)" for t in TERMS)
    return rf"regexp_replace(substr(text, greatest(list_min([{places}]) - 1 - 73, 0) + 1, 220), '^\s+|\s+$', '', 'g')"


_SCORED = f"SELECT doc_id, lang, date, {_score_sql('lower(text)')} AS score, {_snippet_sql()} AS snippet FROM (SELECT *, strftime(day, '%Y-%m-%d') AS date FROM ({DATED})) WHERE score > 0"


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("doc_id", "lang", F.date_format("day", "yyyy-MM-dd").alias("date"), "text")


@register("search_scored", f"{_SCORED} AND lang <> 'de' AND date >= '1996-01-01' ORDER BY date DESC, score DESC, doc_id LIMIT 20")
def search_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest first; kinds and dates prune before the text is scored."""
    docs = _corpus(spark, sf_dir).where((F.col("lang") != "de") & S.dated_between(F.col("date"), since="1996-01-01"))
    return S.scored(docs, TERMS)


@register("search_oldest", f"{_SCORED} ORDER BY date, score, doc_id LIMIT 20")
def search_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scored(_corpus(spark, sf_dir), TERMS, oldest_first=True)


@register(
    "search_positional",
    """WITH q AS (SELECT * FROM (VALUES ('tion,', 0), ('eau', 1)) v(query, query_ord)),
d AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?i)tion,|eau') ORDER BY doc_id DESC LIMIT 50),
p AS (SELECT doc_id, text, query, query_ord, string_split_regex(text, '(?i)' || query) AS parts FROM d, q),
m AS (SELECT doc_id, text, query, query_ord, (list_sum(list_transform(parts[1:i], lambda x: length(x))) + (i - 1) * length(query))::INT AS start
 FROM p, unnest(range(1, len(parts))) u(i))
SELECT doc_id, query, query_ord, start, substr(text, start + 1, length(query)) AS match,
 trim(regexp_replace(substr(text, greatest(start - 90, 0) + 1, start + length(query) + 90 - greatest(start - 90, 0)), '\\s+', ' ', 'g')) AS snippet
FROM m ORDER BY doc_id DESC, query_ord, start LIMIT 50""".replace("\\\\s", "\\s"),
)
def search_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest document first, then query, then place, with snippets of 90 characters to each side."""
    return S.positional(table(spark, sf_dir, "documents"), ["tion,", "eau"])


_KEYS = ["eau", "sch", "tion"]


@register(
    "snippet_earliest",
    """WITH h AS (SELECT doc_id, text, list_min(list_filter([(strpos(text, 'eau'), 0, 3), (strpos(text, 'sch'), 1, 3), (strpos(text, 'tion'), 2, 4)], lambda x: x[1] > 0)) AS h FROM documents),
c AS (SELECT doc_id, text, greatest(h[1] - 1 - 90, 0) AS a, least(length(text), h[1] - 1 + h[3] + 90) AS b FROM h)
SELECT doc_id, CASE WHEN a IS NULL THEN '' ELSE CASE WHEN a > 0 THEN '...' ELSE '' END || trim(regexp_replace(substr(text, a + 1, b - a), '\\s+', ' ', 'g')) || CASE WHEN b < length(text) THEN '...' ELSE '' END END AS snippet
FROM (SELECT c.doc_id, c.text, CASE WHEN h.h IS NOT NULL THEN a END AS a, b FROM c JOIN h USING (doc_id))""",
)
def snippet_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.earliest_snippet(F.col("text"), _KEYS).alias("snippet"))


@register("line_of_offset", "SELECT doc_id, (length(s) - length(replace(s, chr(10), '')) + 1)::BIGINT AS line FROM (SELECT doc_id, substr(text, 1, strpos(text, 'tion') - 1) AS s FROM documents WHERE strpos(text, 'tion') > 0)")
def line_of_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.locate("tion", F.col("text"))
    return table(spark, sf_dir, "documents").where(at > 0).select("doc_id", T.line_of(F.col("text"), at - 1).alias("line"))


def _hit(keyword: str):
    return lambda m: F.struct(F.lit(keyword).alias("keyword"), m["start"].alias("start"), m["match"].alias("match"))


@register("snippets_greedy")
def snippets_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four hits a document, keyword by keyword, each at least 95 characters from all taken before."""
    hits = F.concat(*[F.transform(T.matches(F.col("text"), "(?iu)" + T.literal(k)), _hit(k)) for k in _KEYS])
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(T.spaced_hits(hits, 95, 4)).alias("h"))
    return docs.select("doc_id", "h.keyword", "h.start", T.line_of(F.col("text"), F.col("h.start")).alias("line"), T.around(F.col("text"), F.col("h.start"), F.length("h.match"), 95).alias("snippet"))


ORDERED = f"""WITH k(keyword, ord) AS (VALUES {", ".join(f"('{k}', {i})" for i, k in enumerate(_KEYS))}),
p AS (SELECT doc_id, keyword, ord, unnest(string_split(lower(text), keyword)) AS piece, generate_subscripts(string_split(lower(text), keyword), 1) AS i FROM documents, k),
h AS (SELECT doc_id, keyword, ord, i, (sum(length(piece)) OVER (PARTITION BY doc_id, ord ORDER BY i) + (i - 1) * length(keyword))::BIGINT AS start, count(*) OVER (PARTITION BY doc_id, ord) AS n FROM p),
f AS (SELECT doc_id, keyword, ord, start, row_number() OVER (PARTITION BY doc_id ORDER BY ord, start) AS place FROM h WHERE i < n AND (i = 1 OR start > 80))
SELECT f.doc_id, place::INT AS place, keyword, start::INT AS start, trim(regexp_replace(substr(text, greatest(start - 80, 0) + 1, start + length(keyword) + 80 - greatest(start - 80, 0)), '\\s+', ' ', 'g')) AS snippet FROM f JOIN documents USING (doc_id) WHERE place <= 3"""


@register("snippets_ordered", ORDERED)
def snippets_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three matches of a document, keyword by keyword, with 80 characters to each side."""
    found = T.ordered_snippets(F.col("text"), _KEYS)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(found).alias("at", "s"))
    return rows.select("doc_id", (F.col("at") + 1).alias("place"), "s.keyword", "s.start", "s.snippet")


ALIASES = [("AAA", "the"), ("AAA", "tion"), ("BBB", "eau"), ("CCC", "und"), ("CCC", "la")]
SECTORS = [("food", "de"), ("food", "eau"), ("chips", "on")]
MEMBERS = [("food", "AAA"), ("food", "BBB"), ("food", "ZZZ"), ("chips", "CCC")]
_ALIAS_ROWS = ", ".join(f"('{s}', '{a}')" for s, a in ALIASES)
_SECTOR_ROWS = ", ".join(f"('{s}', '{a}')" for s, a in SECTORS)
_MEMBER_ROWS = ", ".join(f"('{s}', '{m}')" for s, m in MEMBERS)
_BOUND = "regexp_matches(text, '(?i)(^|[^A-Za-z0-9_])' || alias || '([^A-Za-z0-9_]|$)')"
DIRECT = f"SELECT doc_id, symbol, string_agg(alias, ',' ORDER BY alias) AS matched_aliases FROM documents, (VALUES {_ALIAS_ROWS}) v(symbol, alias) WHERE {_BOUND} GROUP BY ALL"
_PROXY = f"SELECT doc_id, m.symbol, string_agg(DISTINCT alias, ',' ORDER BY alias) AS matched_aliases, string_agg(DISTINCT 'sector_basket:' || m.sector, ',' ORDER BY 'sector_basket:' || m.sector) AS sources FROM documents, (VALUES {_SECTOR_ROWS}) v(sector, alias) JOIN (VALUES {_MEMBER_ROWS}) m(sector, symbol) ON m.sector = v.sector WHERE m.symbol IN ('AAA', 'BBB', 'CCC') AND {_BOUND} GROUP BY ALL"


def _direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return M.mentions(M.alias_hits(docs, ALIASES), ["doc_id"])


def _proxies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = M.alias_hits(docs, SECTORS).withColumnRenamed("symbol", "sector")
    known = spark.createDataFrame(list({(s,) for s, _ in ALIASES}), "symbol string")
    return M.sector_proxies(hits, spark.createDataFrame(MEMBERS, "sector string, symbol string"), known, ["doc_id"])


def _flat(found: DataFrame) -> DataFrame:
    return found.withColumns({c: F.array_join(c, ",") for c in ("matched_aliases", "sources") if c in found.columns})


@register("alias_mentions", DIRECT)
def alias_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_direct(spark, sf_dir)).drop("sources")


_TABLE = "(SELECT alias, 'i' || min(item_id) AS symbol FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]{4,}')) AS alias FROM benchmark) GROUP BY alias)"


@register("alias_table_mentions", f"SELECT doc_id, symbol, string_agg(alias, ',' ORDER BY alias) AS matched_aliases FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS alias FROM documents) JOIN {_TABLE} USING (alias) GROUP BY doc_id, symbol")
def alias_table_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that is a table, too large for a pattern each: the words of benchmark items stand for aliases, the first item with one for
    what it means."""
    words = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9_]{4,}"), F.lit(0))).alias("alias"))
    aliases = words.groupBy("alias").agg(F.concat(F.lit("i"), F.min("item_id").cast("string")).alias("symbol"))
    hits = automaton.table_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), aliases)
    return _flat(M.mentions(hits, ["doc_id"])).drop("sources")


@register("sector_proxy", _PROXY)
def sector_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_proxies(spark, sf_dir))


@register("proxy_minus_direct", f"SELECT p.* FROM ({_PROXY}) p ANTI JOIN ({DIRECT}) d ON p.doc_id = d.doc_id AND p.symbol = d.symbol")
def proxy_minus_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(M.proxy_minus_direct(_proxies(spark, sf_dir), _direct(spark, sf_dir), ["doc_id"]))


@register(
    "mentions_united",
    f"""WITH a AS (SELECT doc_id, symbol, unnest(string_split(matched_aliases, ',')) AS x FROM (SELECT doc_id, symbol, matched_aliases FROM ({DIRECT}) UNION ALL SELECT doc_id, symbol, matched_aliases FROM ({_PROXY}))),
s AS (SELECT doc_id, symbol, 'transcript' AS y FROM ({DIRECT}) UNION ALL SELECT doc_id, symbol, unnest(string_split(sources, ',')) FROM ({_PROXY}))
SELECT * FROM (SELECT doc_id, symbol, string_agg(DISTINCT x, ',' ORDER BY x) AS matched_aliases FROM a GROUP BY ALL) JOIN (SELECT doc_id, symbol, string_agg(DISTINCT y, ',' ORDER BY y) AS sources FROM s GROUP BY ALL) USING (doc_id, symbol)""",
)
def mentions_united(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(M.united(_direct(spark, sf_dir), _proxies(spark, sf_dir), ["doc_id"]))


@register("mention_top30", f"SELECT symbol, count(DISTINCT doc_id) AS mentions FROM (SELECT doc_id, symbol FROM ({DIRECT}) UNION ALL SELECT doc_id, symbol FROM ({_PROXY})) GROUP BY symbol ORDER BY mentions DESC, symbol LIMIT 30")
def mention_top30(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _direct(spark, sf_dir).select("doc_id", "symbol").unionByName(_proxies(spark, sf_dir).select("doc_id", "symbol"))
    return M.top_mentioned(both, "doc_id")


OBSERVED = "SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'Alpha' WHEN 4 THEN 'la DE baja' WHEN 1 THEN source WHEN 5 THEN 'made on' WHEN 2 THEN '' WHEN 6 THEN 'chips' ELSE 'food' END AS asset, CASE WHEN doc_id % 3 = 0 THEN 'AAA' WHEN doc_id % 3 = 1 THEN 'QQQ' ELSE '' END AS symbol FROM documents"
_SECTOR_HITS = f"SELECT doc_id, asset, sector, alias FROM ({OBSERVED}), (VALUES {_SECTOR_ROWS}) v(sector, alias) WHERE asset <> '' AND {_BOUND.replace('text', 'asset')} UNION ALL SELECT doc_id, asset, asset, NULL FROM ({OBSERVED}) WHERE asset IN ('food', 'chips')"
_TERMS = f"SELECT DISTINCT doc_id, unnest([sector, alias, asset]) AS term FROM ({_SECTOR_HITS})"
SECTOR_SEEN = f"""SELECT doc_id, symbol, string_agg(DISTINCT a, ',' ORDER BY a) AS matched_aliases, string_agg(DISTINCT s, ',' ORDER BY s) AS sources
FROM (SELECT doc_id, m.symbol, unnest([alias, asset]) AS a, unnest(['sector_basket:' || h.sector, 'trade_observations.asset_or_sector']) AS s FROM ({_SECTOR_HITS}) h JOIN (VALUES {_MEMBER_ROWS}) m(sector, symbol) ON m.sector = h.sector WHERE m.symbol IN ('AAA', 'BBB', 'CCC')) GROUP BY ALL"""


def observed_columns() -> tuple[Column, Column]:
    """What the documents' notes observe: names and sectors, some with a symbol."""
    k = F.col("doc_id")
    asset = F.when(k % 8 == 0, "Alpha").when(k % 8 == 4, "la DE baja").when(k % 8 == 1, F.col("source")).when(k % 8 == 5, "made on").when(k % 8 == 2, "").when(k % 8 == 6, "chips").otherwise("food")
    return asset, F.when(k % 3 == 0, "AAA").when(k % 3 == 1, "QQQ").otherwise("")


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, asset, symbol) of the documents' notes."""
    asset, symbol = observed_columns()
    return table(spark, sf_dir, "documents").select("doc_id", asset.alias("asset"), symbol.alias("symbol"))


def sectors_seen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    known = spark.createDataFrame(sorted({(s,) for s, _ in ALIASES}), "symbol string")
    return M.observed_sectors(observed(spark, sf_dir), SECTORS, spark.createDataFrame(MEMBERS, "sector string, symbol string"), known, ["doc_id"])


@register("sector_observations", SECTOR_SEEN)
def sector_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets of the sectors that notes observe, by a sector's name or an alias of it."""
    return _flat(sectors_seen(spark, sf_dir)[0])


@register(
    "unresolved_mentions",
    f"""WITH o AS ({OBSERVED}), r AS ({_TERMS})
SELECT DISTINCT doc_id, CASE WHEN asset <> '' THEN asset || ' (' || symbol || ')' ELSE symbol END AS mention FROM o WHERE symbol <> '' AND symbol NOT IN ('AAA', 'BBB')
UNION SELECT doc_id, asset FROM o WHERE symbol = '' AND asset <> '' AND asset NOT IN ('Alpha', 'Beta') AND (doc_id, asset) NOT IN (SELECT doc_id, term FROM r WHERE term IS NOT NULL)""",
)
def unresolved_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What notes observe and nothing explains: unknown symbols, and names that are neither an asset nor a term of a sector they matched."""
    known = spark.createDataFrame([("AAA", "Alpha"), ("BBB", "Beta")], "symbol string, name string")
    return M.unresolved(observed(spark, sf_dir), known, sectors_seen(spark, sf_dir)[1], ["doc_id"])


@register("plain_markdown", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), 'https?://\S+', '', 'g'), '(?m)^#+\s*', '', 'g'), '(?m)^\s*[-*]\s*', '', 'g'), '\s+', ' ', 'g')) AS plain FROM documents""")
def plain_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.plain_markdown(F.col("text"), frontmatter=False).alias("plain"))


@register("short_summary", "SELECT doc_id, CASE WHEN length(text) > 500 THEN rtrim(substr(text, 1, 499)) || '...' ELSE text END AS summary FROM documents")
def short_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.short_summary(F.col("text")).alias("summary"))


@register("html_title", "SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"))


@register("html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of pages."""
    return table(spark, sf_dir, "pages").select("page_id", H.html_to_text(F.col("html")).alias("text"))


@register("html_markdown")
def html_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as Markdown, without the noise around the article."""
    return table(spark, sf_dir, "pages").select("page_id", H.html_to_markdown(F.col("html")).alias("markdown"))


@register(
    "page_ids",
    "SELECT page_id, CASE WHEN regexp_extract(url, '/(\\d+)(?:\\.html)?/?(?:[?#].*)?$', 1) <> '' THEN regexp_extract(url, '/(\\d+)(?:\\.html)?/?(?:[?#].*)?$', 1) ELSE substr(sha1(url), 1, 12) END AS article_id, substr(sha1(url), 1, 16) AS digest FROM pages",
)
def page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable ids: the number that ends the address, or else a digest of it."""
    number = F.regexp_extract("url", r"/(\d+)(?:\.html)?/?(?:[?#].*)?$", 1)
    digest = F.sha1("url")
    return table(spark, sf_dir, "pages").select("page_id", F.when(number != "", number).otherwise(F.substring(digest, 1, 12)).alias("article_id"), F.substring(digest, 1, 16).alias("digest"))


@register(
    "hashtags_keywords",
    r"SELECT doc_id, array_to_string(list_distinct_ordered, '|') AS words FROM (SELECT doc_id, list_transform(list_filter(w, lambda x, i: list_position(w, x) = i), lambda x: lower(x)) AS list_distinct_ordered FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[,;|]'), lambda x: trim(x)), lambda x: x <> '') AS w FROM documents))",
)
def hashtags_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited keywords, first occurrences in order."""
    return _keywords(spark, sf_dir, F.col("text"))


@register("hashtags_keywords_whole", oracle_sql()["hashtags_keywords"])
def hashtags_keywords_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that hashtags_keywords had while that one read beginnings."""
    return hashtags_keywords(spark, sf_dir)


def _keywords(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    words = F.filter(F.transform(F.split(text, "[,;|]"), lambda x: F.trim(x)), lambda x: x != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(F.array_distinct(words), lambda x: F.lower(x)), "|").alias("words"))


@register(
    "jaccard_trigram",
    """WITH g AS (SELECT conv_id, turn, role, CASE WHEN length(s) > 3 THEN list_distinct(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) WHEN length(s) > 0 THEN [s] ELSE [] END AS t FROM (SELECT conv_id, turn, role, lower(text) AS s FROM conversations))
SELECT a.conv_id, a.turn, CASE WHEN len(a.t) > 0 AND len(b.t) > 0 THEN round(len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))), 6) ELSE 0 END AS similarity FROM g a JOIN g b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def jaccard_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of the whole texts of consecutive turns, in lower case: each turn with the next number of its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.trigrams(F.lower("text")).alias("t"))
    later = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("u"))
    return turns.join(later, ["conv_id", "turn"]).select("conv_id", "turn", F.round(T.jaccard(F.col("t"), F.col("u")), 6).alias("similarity"))


@register("jaccard_turns")
def jaccard_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of the whole bare texts of consecutive turns: each turn with the next number of its conversation.

    Pairs are found by conversation and number, so a long conversation is not one task."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", T.bare(F.col("text")).alias("s")).select("conv_id", "turn", "role", T.trigrams(F.col("s")).alias("t"))
    later = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next_role"), F.col("t").alias("u"))
    return turns.join(later, ["conv_id", "turn"]).select("conv_id", "turn", "role", "next_role", F.round(T.jaccard(F.col("t"), F.col("u")), 6).alias("similarity"))


@register(
    "duration_parse",
    r"""SELECT event_id, s AS text, CASE WHEN regexp_matches(s, '^\d+(:\d+){0,2}$') THEN list_reduce(list_transform(string_split(s, ':'), lambda x: x::BIGINT), lambda a, b: a * 60 + b) END AS seconds,
 printf('%02d:%02d:%02d', v // 3600, v // 60 % 60, v % 60) AS clock
 FROM (SELECT event_id, event_id * 7 AS v, CASE event_id % 4 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_id % 50 || ':' || event_id % 60 WHEN 2 THEN user_id || ':' || event_id % 60 || ':' || event_id % 59 ELSE event_type || ':1' END AS s FROM events)""",
)
def duration_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, text = F.col("event_id"), lambda c: c.cast("string")
    shown = F.when(k % 4 == 0, text(k)).when(k % 4 == 1, F.concat(text(k % 50), F.lit(":"), text(k % 60))).when(k % 4 == 2, F.concat(text(F.col("user_id")), F.lit(":"), text(k % 60), F.lit(":"), text(k % 59))).otherwise(F.concat("event_type", F.lit(":1")))
    return table(spark, sf_dir, "events").select("event_id", shown.alias("text"), times.duration_seconds(shown).alias("seconds"), times.clock(k * 7).alias("clock"))


@register(
    "author_relevance",
    """SELECT doc_id, score, source = 'src3' OR score >= 2 AS included FROM (SELECT doc_id, source,
 (CASE WHEN contains(lower(substr(text, 1, 40)), 'the') THEN 3 ELSE 0 END + CASE WHEN contains(lower(substr(text, 41)), 'the') THEN 2 ELSE 0 END + CASE WHEN contains(source, 'the') THEN 1 ELSE 0 END
 + CASE WHEN contains(lower(substr(text, 1, 40)), 'src1') THEN 3 ELSE 0 END + CASE WHEN contains(lower(substr(text, 41)), 'src1') THEN 2 ELSE 0 END + CASE WHEN contains(source, 'src1') THEN 1 ELSE 0 END) AS score FROM documents)""",
)
def author_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, which the first 40 characters stand for, description, which is all after it, and source against the terms."""
    return _relevance(spark, sf_dir, F.substr("text", F.lit(41)))


@register("author_relevance_whole", oracle_sql()["author_relevance"])
def author_relevance_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that author_relevance had while that one read beginnings."""
    return author_relevance(spark, sf_dir)


def _relevance(spark: SparkSession, sf_dir: str, description: Column) -> DataFrame:
    fields = {"title": F.substring("text", 1, 40), "description_text": description, "channel_author": F.col("source")}
    score, included = S.author_relevance(fields, ["the", "SRC1"], {"title": 3, "description_text": 2}, F.col("source") == "src3")
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("score"), included.alias("included"))
