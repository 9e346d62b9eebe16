"""The cache of series by span against sets of days."""

import random
from datetime import date, timedelta

import pytest

from glossmark.sources import intervals

DAY0 = date(2024, 1, 1)
SPANS = "symbol string, since date, until date"


def day(i):
    return DAY0 + timedelta(i)


def days_of(rows):
    return {(s, a + timedelta(i)) for s, a, b in rows for i in range((b - a).days + 1)}


def spans(draw, n):
    return [(draw.choice("ABC"), day(a := draw.randint(0, 60)), day(a + draw.randint(-2, 15))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_gaps_are_what_is_wanted_and_not_kept(spark, seed):
    draw = random.Random(seed)
    wanted, kept = spans(draw, 12), spans(draw, 8 * seed)
    frame = lambda x: spark.createDataFrame(x, SPANS)
    found = [tuple(r) for r in intervals.gaps(frame(wanted), frame(kept), "symbol").collect()]
    assert days_of(found) == days_of(wanted) - days_of(kept)
    assert len(found) == sum((s, d - timedelta(1)) not in days_of(found) for s, d in days_of(found))  # as few spans as can be
    assert days_of(tuple(r) for r in intervals.merged(frame(wanted), "symbol").collect()) == days_of(wanted)


def test_a_second_run_fetches_nothing_and_an_overlapping_one_its_gaps(spark, tmp_path):
    cache = intervals.SeriesCache(spark, f"file://{tmp_path}/cache", "symbol string, d date, close double")
    asked = []

    def fetch(missing):
        own = [tuple(r) for r in missing.collect()]
        asked.append(days_of(own))
        rows = [(s, d, float(d.toordinal())) for s, d in days_of(own) if d.weekday() < 5]  # no rows on holidays
        return spark.createDataFrame(rows, "symbol string, d date, close double")

    def through(*wanted):
        got = [tuple(r) for r in cache.through(spark.createDataFrame(list(wanted), SPANS), fetch).collect()]
        assert len(got) == len(set(got)) and {r[:2] for r in got} == {(s, d) for s, d in days_of(wanted) if d.weekday() < 5}

    through(("A", day(0), day(20)), ("B", day(5), day(9)))
    through(("A", day(0), day(20)), ("B", day(6), day(8)))
    assert len(asked) == 1
    through(("A", day(15), day(30)), ("B", day(0), day(12)), ("C", day(1), day(1)))
    assert asked[1] == days_of([("A", day(21), day(30)), ("B", day(0), day(4)), ("B", day(10), day(12)), ("C", day(1), day(1))])
    through(("C", day(1), day(1)))
    assert len(asked) == 2


def test_rows_of_a_run_that_died_are_not_read(spark, tmp_path):
    cache = intervals.SeriesCache(spark, f"file://{tmp_path}/cache", "symbol string, d date, close double")
    lost = spark.createDataFrame([("A", day(0), 1.0, "dead")], "symbol string, d date, close double, run string")
    lost.write.parquet(f"{tmp_path}/cache/rows")
    rows = cache.through(spark.createDataFrame([("A", day(0), day(0))], SPANS), lambda m: m.selectExpr("symbol", "since AS d", "2.0D AS close")).collect()
    assert [tuple(r) for r in rows] == [("A", day(0), 2.0)]


def test_a_broken_cache_is_an_error(spark, tmp_path):
    (tmp_path / "cache" / "spans").mkdir(parents=True)
    (tmp_path / "cache" / "spans" / "part-0.parquet").write_bytes(b"no parquet at all")
    cache = intervals.SeriesCache(spark, f"file://{tmp_path}/cache", "symbol string, d date, close double")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        cache.through(spark.createDataFrame([("A", day(0), day(0))], SPANS), lambda m: m).collect()
