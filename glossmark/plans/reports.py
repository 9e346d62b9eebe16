"""Queries over corpus reports: themes, assets and whole documents, by year and by the market's regime."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.operators import prices
from glossmark.operators import report as R
from glossmark.plans.market import SNAP
from glossmark.plans.tables import DATED, bars, dated
from glossmark.plans.themes import ASSETS, THEMES
from glossmark.registry import register

INDEX, END = "1-URGENT", "2001-12-31"
_DICTIONARIES = {"theme": THEMES, "asset": ASSETS}
_PARTS = {"year": "year", "regime": "regime"}


def regime_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, regime): each calendar day's regime by the index's last bar."""
    days = prices.daily(prices.with_returns(bars(spark, sf_dir).where(F.col("symbol") == INDEX)), END)
    return days.select("day", prices.regime_by_drawdown(F.col("ret_20d_pct"), F.col("drawdown_60d_pct"), F.lit(True)).alias("regime"))


def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dated(spark, sf_dir).withColumn("day", F.when(F.col("doc_id") % 17 != 0, F.col("day")))
    hits = R.document_hits(docs, _DICTIONARIES, ["day"]).join(regime_days(spark, sf_dir), "day", "left").withColumn("year", F.date_format("day", "yyyy"))
    return R.sections(hits, _PARTS)


def _values() -> str:
    return ", ".join(f"('{kind}', '{name}', '{w}')" for kind, entries in _DICTIONARIES.items() for name, words in entries.items() for w in words)


_REGIME = f"""SELECT doc_id, CASE WHEN ret_20d_pct >= 5 AND drawdown_60d_pct >= -3 THEN 'risk-on / momentum' WHEN ret_20d_pct IS NOT NULL AND (ret_20d_pct <= -5 OR drawdown_60d_pct <= -8) THEN 'weak / corrective' ELSE 'mixed / range' END AS regime
 FROM ({DATED}) x ASOF JOIN (SELECT * FROM ({SNAP}) WHERE symbol = '{INDEX}') s ON x.day >= s.d"""
SECTIONS = f"""WITH docs AS (SELECT doc_id, text, CASE WHEN doc_id % 17 <> 0 THEN day END AS day FROM ({DATED})),
n AS (SELECT doc_id, kind, name, sum((length(text) - length(replace(text, w, ''))) // length(w))::BIGINT AS hits FROM docs, (VALUES {_values()}) v(kind, name, w) GROUP BY ALL),
h AS (SELECT doc_id, kind, name, hits FROM n WHERE hits > 0 UNION ALL SELECT doc_id, 'all', '', sum(hits)::BIGINT FROM n GROUP BY doc_id),
r AS (SELECT h.*, day, coalesce(strftime(day, '%Y'), 'unknown') AS year, coalesce(CASE WHEN day IS NOT NULL THEN regime END, 'unknown') AS regime FROM h JOIN docs USING (doc_id) LEFT JOIN ({_REGIME}) USING (doc_id)),
s AS (SELECT kind AS section, name, '' AS part, count(*) AS episodes, sum(hits)::BIGINT AS hits, min(day) AS first_day, max(day) AS last_day FROM r GROUP BY ALL
 UNION ALL SELECT kind || '_year', name, year, count(*), sum(hits)::BIGINT, min(day), max(day) FROM r GROUP BY ALL UNION ALL SELECT kind || '_regime', name, regime, count(*), sum(hits)::BIGINT, min(day), max(day) FROM r GROUP BY ALL),
report AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY hits DESC, name, part) AS place FROM s)"""


@register("corpus_report", f"{SECTIONS} SELECT * FROM report")
def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sections of the corpus report: themes, assets and documents, each whole, by year and by regime; one document in 17 has no day."""
    return report_sections(spark, sf_dir)


_HEADINGS = {"all": "Documents", "theme": "Themes", "theme_year": "Themes by year", "asset": "Assets", "asset_regime": "Assets by regime", "none": "Nothing"}
_ORDER = ", ".join(f"({i}, '{s}', '{h}')" for i, (s, h) in enumerate(_HEADINGS.items()))


@register(
    "corpus_report_markdown",
    f"""{SECTIONS}, l AS (SELECT section, string_agg('| ' || concat_ws(' | ', name, part, episodes, hits) || ' |' || chr(10), '' ORDER BY place) AS body FROM report WHERE place <= 12 GROUP BY section)
SELECT ord::INT AS ord, '## ' || heading || chr(10) || chr(10) || '| name | part | episodes | hits |' || chr(10) || '|---|---|---|---|' || chr(10) || coalesce(body, '') AS value FROM (VALUES {_ORDER}) v(ord, section, heading) LEFT JOIN l USING (section)""",
)
def corpus_report_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as Markdown, a table a section with its first twelve rows."""
    return R.markdown(report_sections(spark, sf_dir), _HEADINGS, 12)


def _listed(part: str) -> str:
    rows = f"string_agg('{{\"part\":\"' || part || '\",\"episodes\":' || episodes || ',\"hits\":' || hits || '}}', ',' ORDER BY part)"
    return f"(SELECT kind, name, {rows} AS {part} FROM (SELECT *, split_part(section, '_', 1) AS kind FROM report WHERE section LIKE '%\\_{part}' ESCAPE '\\') GROUP BY ALL) {part}"


@register(
    "corpus_memory",
    f"""{SECTIONS} SELECT w.section AS kind, w.name, '{{"episodes":' || episodes || ',"hits":' || hits || coalesce(',"first_day":"' || first_day::DATE::VARCHAR || '","last_day":"' || last_day::DATE::VARCHAR || '"', '') || ',"year":[' || year || '],"regime":[' || regime || ']}}' AS memory
 FROM report w JOIN {_listed("year")} ON year.kind = w.section AND year.name = w.name JOIN {_listed("regime")} ON regime.kind = w.section AND regime.name = w.name""",
)
def corpus_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus memory: a JSON document for each theme and asset, and one for all documents, with what each year and regime has of it."""
    return R.memory(report_sections(spark, sf_dir), list(_PARTS))
