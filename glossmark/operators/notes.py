"""Structured notes: values brought to their vocabularies, repair, and validation as error rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.functions import text as T
from glossmark.operators.sync import last_by_key

# fixed values: strings that count as true
TRUTHY = ("1", "true", "yes", "y", "是", "對")


def enum_value(value: Column, allowed: Sequence[str], aliases: Mapping[str, str], fallback: str) -> Column:
    """The value if allowed; else its lower case, else what it or its lower case is an alias of, else fallback. Trimmed first."""
    value = T.strip(F.coalesce(value, F.lit("")))
    low = F.lower(value)
    if aliases:
        table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        exact, lower = F.element_at(table, value), F.element_at(table, low)
    else:
        exact = lower = F.lit(None).cast("string")
    return F.when(value.isin(*allowed), value).when(low.isin(*allowed), low).otherwise(F.coalesce(exact, lower, F.lit(fallback)))


def bool_value(value: Column) -> Column:
    """Whether a string is one that counts as true; null and all else are false."""
    return F.coalesce(F.lower(T.strip(value)).isin(*TRUTHY), F.lit(False))


def short_evidence(text: Column) -> Column:
    text = T.strip(text)
    return F.when(F.length(text) > 200, F.concat(F.substring(text, 1, 197), F.lit("..."))).otherwise(text)


def errors(rules: Sequence[tuple[str, Column]], missing: Sequence[tuple[str, Column]] = ()) -> Column:
    """The messages whose condition holds, in order; if any of missing does, only those: the rest can't be judged without the fields."""
    said = lambda rs: F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in rs])) if rs else F.array().cast("array<string>")
    gone = said(missing)
    return F.when(F.size(gone) > 0, gone).otherwise(said(rules))


def validate_percentages(parts: Column, low: float = 95, high: float = 105) -> Column:
    """True if the numbers don't add up to about a hundred."""
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return ~total.between(low, high)


def dangling(references: Column, ids: Column) -> Column:
    """References, null and '' aside, that name none of ids."""
    return F.filter(references, lambda r: r.isNotNull() & (r != "") & ~F.coalesce(F.array_contains(ids, r), F.lit(False)))


def summary(targets: DataFrame, checked: DataFrame, key: str, found: str = "errors") -> DataFrame:
    """(target, valid, missing, invalid, error, notes): a row for each error with the number of notes that have it, and the overall
    counts beside it; one row without an error if there is none. A target without a checked note is missing.

    targets and checked have a key once each; dangling references count as one error, whatever they refer to."""
    short = lambda e: F.when(F.startswith(e, F.lit("dangling")), F.substring_index(e, ":", 1)).otherwise(e)
    notes = targets.select(key).join(checked.select(key, F.array_distinct(F.transform(F.coalesce(found, F.array().cast("array<string>")), short)).alias("found__")), key, "left")
    size = F.size(F.coalesce("found__", F.array().cast("array<string>")))
    missing = F.col("found__").isNull()
    totals = notes.agg(F.count(F.lit(1)).alias("target"), F.count_if(~missing & (size == 0)).alias("valid"), F.count_if(missing).alias("missing"), F.count_if(size > 0).alias("invalid"))
    rules = notes.select(F.explode("found__").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("notes"))
    return totals.join(rules, F.lit(True), "left")


def settle_batches(outputs: DataFrame, key: str, order: Sequence[str], valid: str) -> DataFrame:
    """One row a key from outputs of repeated runs: the last valid one, or where there is none the last error. An error after a
    valid output changes nothing; a valid output clears the errors before it."""
    rank = F.col(valid).cast("int").alias("rank__")
    return last_by_key(outputs.withColumn("rank__", rank), [key], ["rank__", *order]).drop("rank__")
