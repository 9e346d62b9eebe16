"""Dates, times of day and durations as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Taipei"


def duration_seconds(text: Column) -> Column:
    """`[[hh:]mm:]ss` or a number of seconds; null for anything else."""
    text = F.trim(text)
    total = F.aggregate(F.split(text, ":"), F.lit(0).cast("long"), lambda acc, p: acc * 60 + p.try_cast("long"))
    return F.when(text.rlike(r"^\d+(:\d+){0,2}$"), total)


def clock(seconds: Column) -> Column:
    """hh:mm:ss; hours go on past 24."""
    s = seconds.cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def minute_mark_seconds(text: Column) -> Column:
    """Of the first `mm:ss` in the text; of hh:mm:ss it reads the hours as minutes."""
    m, s = (F.regexp_extract(text, r"(\d{1,3}):(\d{2})", g) for g in (1, 2))
    return F.when(m != "", m.cast("int") * 60 + s.cast("int"))


def date_string(text: Column) -> Column:
    """The first ISO date; without one the first ten characters; '' for null."""
    iso = F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0)
    return F.coalesce(F.when(iso != "", iso).otherwise(F.substring(text, 1, 10)), F.lit(""))


def strict_date(text: Column) -> Column:
    """yyyy-MM-dd and nothing else; null otherwise."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))


def date_in(text: Column) -> Column:
    """The first date of this century in a text, written with hyphens or slashes, as an ISO date; null without one."""
    part = lambda k: F.regexp_extract(text, r"(20\d{2})[-/](\d{1,2})[-/](\d{1,2})", k)
    return F.when(part(1) != "", F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")))


def path_date(path: Column) -> Column:
    """Of a file's name: the first ISO date in it; null without one."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.nullif(F.regexp_extract(name, r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))


def published_local(text: Column) -> Column:
    """A publication time in many shapes as local (Taipei) wall time: epoch seconds, dates, four formats, ISO with or without a zone.
    Without a zone the time is local already; a bare date is its midnight."""
    digits = text.rlike(r"^\d{9,}(\.\d+)?$")
    epoch = F.convert_timezone(F.lit("UTC"), F.lit(ZONE), F.timestamp_seconds(F.when(digits, text.try_cast("double"))).cast("timestamp_ntz"))
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"T|:")
    iso = F.convert_timezone(F.lit("UTC"), F.lit(ZONE), F.when(zoned, F.try_to_timestamp(text)).cast("timestamp_ntz"))
    plain = [F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "yyyy/MM/dd")]
    return F.coalesce(epoch, iso, *[p.cast("timestamp_ntz") for p in plain])


def market_target(local: Column, cutoff: str = "13:35:00") -> tuple[Column, Column]:
    """(day, label): the day itself from the session's cutoff on, before it the day before."""
    after = F.date_format(local, "HH:mm:ss") >= cutoff
    return F.when(after, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1)), F.when(after, "same_day_close").otherwise("prior_close")


def feed_time(text: Column) -> Column:
    """RFC 822 with its weekday, as UTC; null if it can't be read."""
    return F.try_to_timestamp(F.regexp_replace(text, r"^[A-Za-z]{3},\s*", ""), F.lit("d MMM yyyy HH:mm:ss z"))
