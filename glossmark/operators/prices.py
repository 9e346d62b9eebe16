"""Daily closes: trailing returns, drawdowns, regimes, and the last bar known by a day (backward as-of join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOOKBACKS = (1, 5, 20, 60)


def with_returns(bars: DataFrame, lookbacks: Sequence[int] = LOOKBACKS, peak_bars: int = 60) -> DataFrame:
    """bars (symbol, d, close) with ret_{n}d_pct over n observations and drawdown_60d_pct from the peak of the last 60.

    Null where history is short or the base is 0; two decimals, halves to even. One window serves all columns."""
    past = W.partitionBy("symbol").orderBy("d")
    peak = F.max("close").over(past.rowsBetween(1 - peak_bars, 0))
    base = {n: F.lag("close", n).over(past) for n in lookbacks}
    returns = {f"ret_{n}d_pct": F.when(b != 0, F.bround((F.col("close") / b - 1) * 100, 2)) for n, b in base.items()}
    return bars.withColumns(returns | {"drawdown_60d_pct": F.when(peak != 0, F.bround((F.col("close") / peak - 1) * 100, 2))})


def as_of(targets: DataFrame, bars: DataFrame, on: str = "symbol", target_day: str = "target", bar_day: str = "d") -> DataFrame:
    """targets with the last bar of their symbol on or before their day; bar columns are null if there is none.

    Both sides are merged and sorted once; the bar last seen goes on to the targets behind it. Bars of a day come before
    targets of it, so equality counts. One shuffle by symbol, whose targets and bars are one group: pass distinct days, which the
    calendar bounds, and join what has them afterwards (as_of_days); see as_of_ranged for more."""
    values = [c for c in bars.columns if c != on]
    bar = F.struct(*values)
    keep = [c for c in targets.columns if c != on]
    left = targets.select(F.col(on).alias("k__"), F.col(target_day).alias("t__"), F.lit(1).alias("side__"), F.struct(*keep).alias("row__"), F.lit(None).cast(bars.select(bar).schema[0].dataType).alias("bar__"))
    right = bars.select(F.col(on).alias("k__"), F.col(bar_day).alias("t__"), F.lit(0).alias("side__"), F.lit(None).cast(targets.select(F.struct(*keep)).schema[0].dataType).alias("row__"), bar.alias("bar__"))
    order = W.partitionBy("k__").orderBy("t__", "side__").rowsBetween(W.unboundedPreceding, 0)
    seen = left.unionByName(right).withColumn("bar__", F.last("bar__", ignorenulls=True).over(order)).where("side__ = 1")
    return seen.select(F.col("k__").alias(on), "row__.*", "bar__.*")


def daily(bars: DataFrame, end: str, on: str = "symbol", bar_day: str = "d") -> DataFrame:
    """bars for each calendar day from a symbol's first bar to end: a day without a bar has the last one before it.

    A row a symbol and day, which the calendar bounds: rows with a day then join it by equality, without an as-of join of their own. Bars after end
    are left out; bars of one day should be one."""
    of = W.partitionBy(on).orderBy(bar_day)
    rows = bars.where(F.col(bar_day) <= F.lit(end).cast("date"))
    until = F.coalesce(F.date_sub(F.lead(bar_day).over(of), 1), F.lit(end).cast("date"))
    return rows.withColumn("until__", until).select(F.explode(F.sequence(bar_day, "until__")).alias("day"), *bars.columns)


def as_of_days(rows: DataFrame, bars: DataFrame, on: str = "symbol", target_day: str = "target", bar_day: str = "d") -> DataFrame:
    """rows (target_day, others) by each symbol of bars, with its last bar on or before the day; bar columns are null if there is none.

    The as-of join sees each distinct day and symbol once, however many rows have the day; the rows are joined with its result
    by day. A row without a day has no bar of any symbol."""
    days = rows.where(F.col(target_day).isNotNull()).select(target_day).distinct()
    symbols = bars.select(on).distinct()
    found = as_of(days.crossJoin(symbols), bars, on, target_day, bar_day).withColumnRenamed(target_day, "of_day__")
    undated = symbols.select(on, F.lit(None).cast(dict(rows.dtypes)[target_day]).alias("of_day__"))
    found = found.unionByName(undated, allowMissingColumns=True)
    joined = rows.join(found, F.col(target_day).eqNullSafe(F.col("of_day__")))
    return joined.select(target_day, *[c for c in rows.columns if c != target_day], *[c for c in found.columns if c != "of_day__"])


def as_of_keys(rows: DataFrame, bars: DataFrame, on: str = "symbol", target_day: str = "target", bar_day: str = "d") -> DataFrame:
    """rows (on, target_day, others) with the last bar of their own symbol on or before their day, by distinct pairs of the two; a row whose
    symbol or day is null has no bar."""
    pairs = rows.where(F.col(on).isNotNull() & F.col(target_day).isNotNull()).select(on, target_day).distinct()
    return rows.join(as_of(pairs, bars, on, target_day, bar_day), [on, target_day], "left")


def as_of_ranged(targets: DataFrame, bars: DataFrame, on: str = "symbol", target_day: str = "target", bar_day: str = "d", days: int = 366) -> DataFrame:
    """as_of for many targets of a symbol: time is cut into spans, and each span begins with the last bar before it.

    The carried bar is found from one row a symbol and span, so this join needs no symbol's whole history in a task."""
    epoch = F.lit("1970-01-01").cast("date")
    span = lambda d: F.floor(F.datediff(d, epoch) / days)
    values = [c for c in bars.columns if c != on]
    last = bars.groupBy(on, span(F.col(bar_day)).alias("span__")).agg(F.max_by(F.struct(*values), F.col(bar_day)).alias("bar__"))
    wanted = targets.select(on, span(F.col(target_day)).alias("span__")).distinct()
    order = W.partitionBy(on).orderBy("span__", "side__").rowsBetween(W.unboundedPreceding, 0)
    both = wanted.select(on, (F.col("span__") - F.lit(0)).alias("span__"), F.lit(0).alias("side__"), F.lit(None).cast(last.schema["bar__"].dataType).alias("bar__")).unionByName(last.select(on, "span__", F.lit(1).alias("side__"), "bar__"))
    carried = both.withColumn("bar__", F.last("bar__", ignorenulls=True).over(order)).where("side__ = 0 and bar__ is not null")
    key = F.struct(F.col(on), F.col("span__")).alias("key__")
    seeded = bars.withColumn("span__", span(F.col(bar_day))).select(key, *values).unionByName(carried.select(key, "bar__.*"))
    found = as_of(targets.withColumn("span__", span(F.col(target_day))).withColumn("key__", key).drop("span__"), seeded, "key__", target_day, bar_day)
    return found.drop("key__").select(on, *[c for c in found.columns if c not in {on, "key__"}])


def regime_by_returns(returns20: Column, returns60: Column) -> Column:
    """Six labels from arrays of the 20 and 60 bar returns of the symbols that are there; empty arrays: unknown."""
    some = lambda values, test: F.exists(values, test)
    known = (F.size(returns20) > 0) | (F.size(returns60) > 0)
    return (
        F.when(~known, "unknown")
        .when(some(returns20, lambda x: x <= -15) | some(returns60, lambda x: x <= -25), "risk-off / drawdown")
        .when(some(returns20, lambda x: x >= 15) | some(returns60, lambda x: x >= 25), "risk-on / momentum")
        .when(some(returns20, lambda x: x <= -7), "weak / corrective")
        .when(some(returns20, lambda x: x >= 7), "constructive / rising")
        .otherwise("mixed / range")
    )


def regime_by_drawdown(ret20: Column, drawdown: Column, known: Column) -> Column:
    """Four labels from an index's 20 bar return and drawdown; what is missing leaves it mixed."""
    return (
        F.when(~known, "unknown")
        .when((ret20 >= 5) & (drawdown >= -3), "risk-on / momentum")
        .when(ret20.isNotNull() & drawdown.isNotNull() & ((ret20 <= -5) | (drawdown <= -8)), "weak / corrective")
        .otherwise("mixed / range")
    )


def regime_tags(ret20: Column, drawdown: Column, chips20: Column, fear5: Column) -> Column:
    both = ret20.isNotNull() & drawdown.isNotNull()
    strong, weak = both & (ret20 >= 5) & (drawdown >= -3), both & ((ret20 <= -5) | (drawdown <= -8))
    tags = [F.when(strong, "momentum").when(weak, "correction").when(both & (F.abs(ret20) <= 2), "range"), F.when(chips20 >= 5, "chips_strong"), F.when(fear5 >= 10, "fear_rising")]
    return F.array_compact(F.array(*tags))


def pricing_symbol(symbol: Column, override: Column, has_override: Column) -> Column:
    """What an asset is priced by: its override where it has one, even if that is empty (no public symbol); else its own symbol."""
    return F.when(has_override, F.coalesce(override, F.lit(""))).otherwise(symbol)


def symbol_slug(symbol: Column) -> Column:
    """A name for files: `^` as INDEX_, other characters than letters, digits, dot, underscore and hyphen as one underscore a run."""
    return F.regexp_replace(F.replace(symbol, F.lit("^"), F.lit("INDEX_")), r"[^A-Za-z0-9._-]+", "_")


def slug_symbol(slug: Column) -> Column:
    """The symbol again, but for what the slug has lost: keep the symbol beside it."""
    return F.replace(slug, F.lit("INDEX_"), F.lit("^"))


def pricing_status(has_date: Column, pricing_symbol: Column, has_series: Column, has_bar: Column) -> Column:
    """A present but empty pricing symbol means that there is no public one."""
    return (
        F.when(~has_date, "missing_episode_date")
        .when(F.coalesce(pricing_symbol, F.lit("")) == "", "no_public_symbol")
        .when(~has_series, "missing_price_series")
        .when(~has_bar, "no_prior_price")
        .otherwise("ok")
    )


def latest_snapshot(bars: DataFrame) -> DataFrame:
    newest = W.partitionBy("symbol").orderBy(F.desc("d"))
    return with_returns(bars).withColumn("rn__", F.row_number().over(newest)).where("rn__ = 1").drop("rn__")


def padded_bounds(days: DataFrame, day: str, before: int = 100, after: int = 5) -> DataFrame:
    return days.agg(F.date_sub(F.min(day), before).alias("start_day"), F.date_add(F.max(day), after).alias("end_day"), F.count(day).alias("dated"))
