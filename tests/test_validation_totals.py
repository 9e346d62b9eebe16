import datetime
from collections import Counter

from glossmark.operators import notes as N
from glossmark.plans import jobs, passages


def test_all_errors_count(spark, small):
    errors = [[e for e in r.errors.split("; ") if e] for r in passages.note_validate(spark, small).collect()]
    rules = Counter(e for es in errors for e in {"dangling" if e.startswith("dangling") else e for e in es})
    rows = jobs.validation_totals(spark, small).collect()
    assert {r.error: r.notes for r in rows} == rules and rules["dangling"]
    assert {tuple(r)[:4] for r in rows} == {(len(errors), sum(not e for e in errors), 0, sum(bool(e) for e in errors))}


def test_missing_and_dangling(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(1, at, 1, "click", 98.0, '{"k": 3}'), (2, at, 1, "view", 98.0, '{"k": 2}'), (3, at, 1, "view", 1.0, None), (4, at, 1, "error", 98.0, '{"k": 5}')]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    found = sorted(tuple(r) for r in jobs.validation_totals(spark, str(tmp_path)).collect())
    assert found == [(4, 1, 1, 2, "dangling", 2), (4, 1, 1, 2, "event_type: unknown value", 1)]


def test_no_errors(spark):
    targets = spark.createDataFrame([(1,), (2,)], "id long")
    checked = spark.createDataFrame([(1, [])], "id long, errors array<string>")
    assert [tuple(r) for r in N.summary(targets, checked, "id").collect()] == [(2, 1, 1, 0, None, None)]
