"""Queries over prices: returns, drawdowns, as-of alignment, regimes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.functions import times
from glossmark.operators import prices
from glossmark.plans.tables import BARS, DATED, bars, dated, table
from glossmark.registry import register

_RET = ", ".join(f"CASE WHEN lag(close, {n}) OVER w <> 0 THEN round_even((close / lag(close, {n}) OVER w - 1) * 100, 2) END AS ret_{n}d_pct" for n in prices.LOOKBACKS)
_PEAK = "round_even((close / max(close) OVER (PARTITION BY symbol ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) - 1) * 100, 2) AS drawdown_60d_pct"
SNAP = f"SELECT symbol, d, close, {_RET}, {_PEAK} FROM ({BARS}) WINDOW w AS (PARTITION BY symbol ORDER BY d)"
_COLS = ", ".join(f"ret_{n}d_pct" for n in prices.LOOKBACKS)


@register("returns_by_symbol", f"SELECT symbol, d, close, {_COLS} FROM ({SNAP})")
def returns_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.with_returns(bars(spark, sf_dir)).drop("drawdown_60d_pct")


@register("drawdown_60", f"SELECT symbol, d, close, drawdown_60d_pct FROM ({SNAP})")
def drawdown_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.with_returns(bars(spark, sf_dir), ()).select("symbol", "d", "close", "drawdown_60d_pct")


def _aligned(spark: SparkSession, sf_dir: str, shift: int) -> DataFrame:
    rows = dated(spark, sf_dir).select("doc_id", F.date_sub("day", shift).alias("target"))
    found = prices.as_of_days(rows, prices.with_returns(bars(spark, sf_dir)))
    return found.select("symbol", "doc_id", "target", *[c for c in found.columns if c not in ("symbol", "doc_id", "target")])


def _aligned_sql(shift: int) -> str:
    return f"""WITH snap AS ({SNAP}), t AS (SELECT doc_id, day - {shift} AS target, symbol FROM ({DATED}), (SELECT DISTINCT symbol FROM snap))
SELECT t.symbol, doc_id, target, s.d, s.close, {_COLS}, drawdown_60d_pct FROM t ASOF LEFT JOIN snap s ON t.symbol = s.symbol AND t.target >= s.d"""


_REGIME6 = """CASE WHEN len(r20) = 0 AND len(r60) = 0 THEN 'unknown'
 WHEN list_min(r20) <= -15 OR list_min(r60) <= -25 THEN 'risk-off / drawdown' WHEN list_max(r20) >= 15 OR list_max(r60) >= 25 THEN 'risk-on / momentum'
 WHEN list_min(r20) <= -7 THEN 'weak / corrective' WHEN list_max(r20) >= 7 THEN 'constructive / rising' ELSE 'mixed / range' END"""


@register("asof_snapshot", _aligned_sql(0))
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each dated document and symbol with the last snapshot on or before its day."""
    return _aligned(spark, sf_dir, 0)


@register("asof_prior_day", _aligned_sql(1))
def asof_prior_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for publications before the session: the day before is the last that counts."""
    return _aligned(spark, sf_dir, 1)


@register(
    "market_context_csv_rows",
    f"""WITH a AS ({_aligned_sql(0)}) SELECT doc_id, symbol, coalesce(strftime(d, '%Y-%m-%d'), '') AS market_date, coalesce(printf('%.4f', close), '') AS close_text FROM a WHERE d IS NOT NULL""",
)
def market_context_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long CSV of the alignment: a row a document and symbol that has a bar."""
    rows = _aligned(spark, sf_dir, 0).where("d is not null")
    return rows.select("doc_id", "symbol", F.date_format("d", "yyyy-MM-dd").alias("market_date"), F.format_string("%.4f", "close").alias("close_text"))


@register(
    "session_cutoff_target",
    """SELECT event_id, CASE WHEN ts::TIME >= TIME '13:35:00' THEN ts::DATE ELSE ts::DATE - 1 END AS target_day,
 CASE WHEN ts::TIME >= TIME '13:35:00' THEN 'same_day_close' ELSE 'prior_close' END AS label FROM events""",
)
def session_cutoff_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, label = times.market_target(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", day.alias("target_day"), label.alias("label"))


@register("latest_snapshot", f"SELECT * FROM ({SNAP}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY d DESC) = 1")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.latest_snapshot(bars(spark, sf_dir))


_SLOTS = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@register(
    "regime_6",
    f"""WITH a AS ({_aligned_sql(0)}), g AS (SELECT doc_id, coalesce(list(ret_20d_pct) FILTER (ret_20d_pct IS NOT NULL), []) AS r20, coalesce(list(ret_60d_pct) FILTER (ret_60d_pct IS NOT NULL), []) AS r60
 FROM a WHERE symbol IN {_SLOTS} AND d IS NOT NULL GROUP BY doc_id) SELECT doc_id, {_REGIME6} AS regime FROM g""",
)
def regime_6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regime of each document's day from three symbol slots."""
    rows = _aligned(spark, sf_dir, 0).where(F.col("symbol").isin(*_SLOTS) & F.col("d").isNotNull())
    slots = rows.groupBy("doc_id").agg(F.collect_list("ret_20d_pct").alias("r20"), F.collect_list("ret_60d_pct").alias("r60"))
    return slots.select("doc_id", prices.regime_by_returns(F.col("r20"), F.col("r60")).alias("regime"))


@register(
    "regime_4",
    f"""WITH a AS ({_aligned_sql(0)}) SELECT doc_id, CASE WHEN d IS NULL THEN 'unknown' WHEN ret_20d_pct >= 5 AND drawdown_60d_pct >= -3 THEN 'risk-on / momentum'
 WHEN ret_20d_pct IS NOT NULL AND (ret_20d_pct <= -5 OR drawdown_60d_pct <= -8) THEN 'weak / corrective' ELSE 'mixed / range' END AS regime FROM a WHERE symbol = '1-URGENT'""",
)
def regime_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _aligned(spark, sf_dir, 0).where(F.col("symbol") == "1-URGENT")
    return rows.select("doc_id", prices.regime_by_drawdown(F.col("ret_20d_pct"), F.col("drawdown_60d_pct"), F.col("d").isNotNull()).alias("regime"))


@register(
    "regime_histogram",
    f"""WITH a AS ({_aligned_sql(0)}), r AS (SELECT day, CASE WHEN d IS NULL THEN 'unknown' WHEN ret_20d_pct >= 5 AND drawdown_60d_pct >= -3 THEN 'risk-on / momentum'
 WHEN ret_20d_pct IS NOT NULL AND (ret_20d_pct <= -5 OR drawdown_60d_pct <= -8) THEN 'weak / corrective' ELSE 'mixed / range' END AS regime FROM a JOIN ({DATED}) USING (doc_id) WHERE symbol = '1-URGENT')
 SELECT regime, count(*) AS episodes, min(day) AS first_day, max(day) AS last_day FROM r GROUP BY regime""",
)
def regime_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regime_4(spark, sf_dir).join(dated(spark, sf_dir).select("doc_id", "day"), "doc_id").groupBy("regime").agg(F.count(F.lit(1)).alias("episodes"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


_ASSET_OF = {"en": "1-URGENT", "de": "3-MEDIUM", "fr": "9-NONE", "es": "5-LOW"}
_OVERRIDES = {"de": "", "es": "2-HIGH"}


@register(
    "pricing_status",
    f"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN day - 1200 END AS target, CASE lang WHEN 'de' THEN '' WHEN 'es' THEN '2-HIGH' WHEN 'en' THEN '1-URGENT' WHEN 'fr' THEN '9-NONE' END AS symbol FROM ({DATED})),
 b AS ({BARS}), j AS (SELECT t.*, b.d FROM t ASOF LEFT JOIN b ON t.symbol = b.symbol AND t.target >= b.d)
 SELECT doc_id, symbol AS pricing_symbol, CASE WHEN target IS NULL THEN 'missing_episode_date' WHEN coalesce(symbol, '') = '' THEN 'no_public_symbol'
 WHEN symbol NOT IN (SELECT symbol FROM b) THEN 'missing_price_series' WHEN d IS NULL THEN 'no_prior_price' ELSE 'ok' END AS status FROM j""",
)
def pricing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a mentioned asset has a price or not; languages stand for assets, two of them with a pricing symbol of their own."""
    of = lambda table_: F.create_map(*[F.lit(x) for kv in table_.items() for x in kv])
    symbol = prices.pricing_symbol(of(_ASSET_OF)[F.col("lang")], of(_OVERRIDES)[F.col("lang")], F.coalesce(F.col("lang").isin(*_OVERRIDES), F.lit(False)))
    targets = dated(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.date_sub("day", 1200)).alias("target"), symbol.alias("symbol"))
    days = bars(spark, sf_dir)
    series = days.select("symbol").distinct().withColumn("has_series", F.lit(True))
    rows = prices.as_of_keys(targets, days).join(series, "symbol", "left")
    status = prices.pricing_status(F.col("target").isNotNull(), F.col("symbol"), F.coalesce("has_series", F.lit(False)), F.col("d").isNotNull())
    return rows.select("doc_id", F.col("symbol").alias("pricing_symbol"), status.alias("status"))


@register("market_bounds", f"SELECT min(day) - 100 AS start_day, max(day) + 5 AS end_day, count(day) AS dated FROM ({DATED})")
def market_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.padded_bounds(dated(spark, sf_dir), "day")
