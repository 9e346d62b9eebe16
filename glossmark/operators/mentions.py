"""Assets and sectors that documents mention, by alias: pattern joins against small dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.functions import text as T
from glossmark.operators.automaton import table_hits

#: So many aliases are literals of one array expression; more are found by an automaton (see automaton.table_hits).
INLINE_ALIASES = 32


def alias_hits(docs: DataFrame, aliases: Sequence[tuple[str, str]], text: str = "text") -> DataFrame:
    """docs' other columns with symbol and alias, for each alias the text has; ASCII aliases only as whole words.

    A few aliases are patterns, each compiled once, and a text is looked at where it lies; many go into one automaton."""
    if len(aliases) > INLINE_ALIASES:
        return table_hits(docs, docs.sparkSession.createDataFrame(list(aliases), "symbol string, alias string"), text)
    hits = [F.when(F.col(text).rlike(T.alias_pattern(a)), F.struct(F.lit(s).alias("symbol"), F.lit(a).alias("alias"))) for s, a in aliases]
    keep = [c for c in docs.columns if c != text]
    return docs.select(*keep, F.explode(F.array_compact(F.array(*hits))).alias("hit__")).select(*keep, "hit__.*")


def mentions(hits: DataFrame, keys: Sequence[str], source: str = "transcript") -> DataFrame:
    return hits.groupBy(*keys, "symbol").agg(F.array_sort(F.collect_set("alias")).alias("matched_aliases")).withColumn("sources", F.array(F.lit(source)))


def sector_proxies(sector_hits: DataFrame, members: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """sector_hits (keys, sector, alias) to the sectors' member symbols that are known assets; a symbol's aliases and sectors are united."""
    listed = members.join(known.select("symbol").distinct(), "symbol", "left_semi")
    found = sector_hits.join(listed, "sector")
    return found.groupBy(*keys, "symbol").agg(F.array_sort(F.collect_set("alias")).alias("matched_aliases"), F.array_sort(F.collect_set(F.concat(F.lit("sector_basket:"), "sector"))).alias("sources"))


def proxy_minus_direct(proxies: DataFrame, direct: DataFrame, keys: Sequence[str]) -> DataFrame:
    return proxies.join(direct.select(*keys, "symbol").distinct(), [*keys, "symbol"], "left_anti")


def united(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mentions of both, aliases and sources united and sorted."""
    both = a.unionByName(b)
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return both.groupBy(*keys, "symbol").agg(flat("matched_aliases"), flat("sources"))


def unresolved(observations: DataFrame, known: DataFrame, resolved_terms: DataFrame, keys: Sequence[str]) -> DataFrame:
    """observations (keys, asset, symbol) that no asset explains: symbols nobody lists, and names without a symbol that are neither
    an asset's name nor a sector term that the document resolved."""
    asset, symbol = F.trim(F.coalesce("asset", F.lit(""))), F.coalesce("symbol", F.lit(""))
    rows = observations.withColumn("asset", asset).withColumn("symbol", symbol)
    by_symbol = rows.where("symbol <> ''").join(known.select("symbol").distinct(), "symbol", "left_anti")
    by_symbol = by_symbol.select(*keys, F.when(F.col("asset") != "", F.concat("asset", F.lit(" ("), "symbol", F.lit(")"))).otherwise(F.col("symbol")).alias("mention"))
    by_name = rows.where("symbol = '' and asset <> ''").join(known.select(F.col("name").alias("asset")).distinct(), "asset", "left_anti")
    by_name = by_name.join(resolved_terms.select(*keys, F.col("term").alias("asset")).distinct(), [*keys, "asset"], "left_anti").select(*keys, F.col("asset").alias("mention"))
    return by_symbol.unionByName(by_name).distinct()


def observed_symbols(observations: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, symbol, matched_aliases, sources): symbols that observations (keys, asset, symbol) name and that are known assets."""
    found = observations.where("symbol <> ''").join(known.select("symbol").distinct(), "symbol", "left_semi").select(*keys, "symbol").distinct()
    return found.select(*keys, "symbol", F.array().cast("array<string>").alias("matched_aliases"), F.array(F.lit("trade_observations.asset_symbol")).alias("sources"))


def observed_sectors(observations: DataFrame, aliases: Sequence[tuple[str, str]], members: DataFrame, known: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(mentions, terms) of observations (keys, asset, symbol) whose asset is a sector's name or has one of its aliases (sector, alias).

    mentions (keys, symbol, matched_aliases, sources): the sectors' members that are known assets, with the aliases and the asset itself. terms
    (keys, term): the sector names, aliases and assets that are thereby explained."""
    asset = F.trim(F.coalesce("asset", F.lit("")))
    rows = observations.select(*keys, asset.alias("asset")).where("asset <> ''").distinct()
    by_alias = alias_hits(rows.withColumn("text__", F.col("asset")), aliases, "text__").withColumnRenamed("symbol", "sector")
    names = rows.sparkSession.createDataFrame(sorted({(s,) for s, _ in aliases}), "sector string")
    by_name = rows.join(names, rows["asset"] == names["sector"]).select(*keys, "asset", "sector", F.lit(None).cast("string").alias("alias"))
    hits = by_alias.select(*keys, "asset", "sector", "alias").unionByName(by_name)
    listed = hits.join(members.join(known.select("symbol").distinct(), "symbol", "left_semi"), "sector")
    flat = listed.groupBy(*keys, "symbol").agg(F.collect_set("alias").alias("a__"), F.collect_set("asset").alias("b__"), F.collect_set(F.concat(F.lit("sector_basket:"), "sector")).alias("s__"))
    found = flat.select(*keys, "symbol", F.array_sort(F.array_union("a__", "b__")).alias("matched_aliases"), F.array_sort(F.array_append("s__", "trade_observations.asset_or_sector")).alias("sources"))
    terms = hits.select(*keys, F.explode(F.array_compact(F.array("sector", "alias", "asset"))).alias("term")).distinct()
    return found, terms


def context_mentions(rows: DataFrame, keys: Sequence[str], aliases: Sequence[tuple[str, str]], sectors: Sequence[tuple[str, str]], members: Sequence[tuple[str, str]], text: str = "text", asset: str = "asset", symbol: str = "symbol") -> DataFrame:
    """(keys, symbol, matched_aliases, sources): all that documents (keys, text, asset, symbol) mention, in one scan and one grouping.

    It is the union of direct mentions by alias, of what their notes observe as a symbol, a sector's name or one of its aliases, and of the members of
    sectors that the text names, but for symbols that it mentions directly. Known assets are those with an alias. A text is looked at where it lies; a hit
    is a row of its symbols, tagged with what it is, and a direct one wins over a sector's inside its group. For dictionaries small enough to be literals;
    larger ones are joined (see united)."""
    known = {s for s, _ in aliases}
    of_sector = {s: sorted({m for t, m in members if t == s and m in known}) for s, _ in sectors}
    words = lambda *xs: F.array(*[x if isinstance(x, Column) else F.lit(x) for x in xs]).cast("array<string>")
    seen, named = F.trim(F.coalesce(asset, F.lit(""))), F.coalesce(symbol, F.lit(""))

    def hit(test: Column, kind: str, symbols: Column, said: Column, sources: Column) -> Column:
        return F.when(test, F.struct(F.lit(kind).alias("kind"), symbols.alias("symbols"), said.alias("said"), sources.alias("sources")))

    hits = [hit(F.col(text).rlike(T.alias_pattern(a)), "direct", words(s), words(a), words("transcript")) for s, a in aliases]
    for s, a in sectors:
        basket = f"sector_basket:{s}"
        hits.append(hit(F.col(text).rlike(T.alias_pattern(a)), "proxy", words(*of_sector[s]), words(a), words(basket)))
        hits.append(hit(seen.rlike(T.alias_pattern(a)), "seen", words(*of_sector[s]), words(a, seen), words(basket, "trade_observations.asset_or_sector")))
    for s, own in of_sector.items():
        hits.append(hit(seen == s, "seen", words(*own), words(seen), words(f"sector_basket:{s}", "trade_observations.asset_or_sector")))
    hits.append(hit(named.isin(*known), "named", words(named), words(), words("trade_observations.asset_symbol")))
    flat = rows.select(*keys, F.explode(F.array_compact(F.array(*hits))).alias("h__")).select(*keys, F.explode("h__.symbols").alias("symbol"), "h__.kind", "h__.said", "h__.sources")
    proxy = F.col("kind") == "proxy"
    sums = {f"{c}_{n}": F.flatten(F.collect_list(F.when(test, F.col(c)))) for c in ("said", "sources") for n, test in (("own", ~proxy), ("proxy", proxy))}
    grouped = flat.groupBy(*keys, "symbol").agg(F.max(F.col("kind") == "direct").alias("direct"), *[c.alias(n) for n, c in sums.items()])
    both = lambda c: F.array_sort(F.array_distinct(F.when(F.col("direct"), F.col(f"{c}_own")).otherwise(F.concat(f"{c}_own", f"{c}_proxy"))))
    return grouped.select(*keys, "symbol", both("said").alias("matched_aliases"), both("sources").alias("sources"))


def with_context_flag(views: DataFrame, direct: DataFrame, keys: Sequence[str]) -> DataFrame:
    """views (keys, symbol, others) with context_status: whether the record's direct mentions have priced the symbol already."""
    priced = direct.where("symbol <> ''").select(*keys, "symbol", F.lit("priced_in_episode_asset_context").alias("context_status")).distinct()
    return views.join(priced, [*keys, "symbol"], "left")


def top_mentioned(found: DataFrame, key: str, k: int = 30) -> DataFrame:
    return found.groupBy("symbol").agg(F.count_distinct(key).alias("mentions")).orderBy(F.desc("mentions"), "symbol").limit(k)
