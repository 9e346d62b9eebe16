import json

from pyspark.sql import functions as F

from glossmark.operators import note_jobs as J

GOOD = {"episode": 1, "date": "d", "title": "t", "market_regime": "m", "topics": ["a", "b", "c"], "investment_logic": [], "trade_observations": [], "qa_views": [], "open_questions": []}
OUT = "id long, attempt int, record string, title string"


def jobs(spark, ids, outputs):
    form = J.first_format(F.col("title"))
    rows = J.job(spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(outputs, OUT), "id", ["attempt"], "record", form)
    return {r.id: (r.status, r.n_errors, list(r.errors)) for r in rows.collect()}


def test_runs_are_settled(spark):
    good, bad = json.dumps(GOOD), json.dumps(GOOD | {"topics": ["a"]})
    found = jobs(
        spark,
        [1, 2, 3, 4, 5, 6],
        [(1, 0, good, "x"), (1, 1, bad, "x"), (2, 0, bad, "x"), (2, 1, None, "x"), (3, 0, "no json", "x"), (4, 0, "", None), (6, 0, json.dumps({"content": GOOD | {"title": None}}), "named"), (9, 0, good, "x")],
    )
    few = ["topics must contain 3-8 items"]
    assert found == {1: ("valid", 0, []), 2: ("invalid", 1, few), 3: ("missing", 0, []), 4: ("missing", 0, []), 5: ("missing", 0, []), 6: ("valid", 0, [])}


def test_all_errors_are_counted_and_twenty_kept(spark):
    seen = [{"asset_or_sector": "a"} for _ in range(15)]
    status, n, kept = jobs(spark, [1], [(1, 0, json.dumps(GOOD | {"trade_observations": seen}), "x")])[1]
    assert (status, n, len(kept)) == ("invalid", 30, J.MOST_ERRORS)  # each lacks reasoning and market_alignment


def test_no_outputs_and_no_targets(spark):
    assert jobs(spark, [1], []) == {1: ("missing", 0, [])}
    assert jobs(spark, [], [(1, 0, json.dumps(GOOD), "x")]) == {}


def test_totals_by_rule(spark):
    rows = [("f", "valid", []), ("f", "missing", []), ("f", "invalid", ["a[0].b invalid: x y", "a[1].b invalid: z", "missing c"]), ("f", "invalid", ["a[7] missing catalyst: k"]), ("g", "valid", [])]
    found = J.totals(spark.createDataFrame(rows, "form string, status string, errors array<string>"), "form").collect()
    counts = {(r.form, r.rule): (r.target, r.valid, r.missing, r.invalid, r.notes) for r in found}
    assert counts == {("f", "a[].b invalid"): (4, 1, 1, 2, 1), ("f", "missing c"): (4, 1, 1, 2, 1), ("f", "a[] missing catalyst"): (4, 1, 1, 2, 1), ("g", None): (1, 1, 0, 0, None)}


def test_requests_for_what_is_open(spark):
    targets = spark.createDataFrame([(i, "p" * i) for i in range(1, 8)] + [(None, "x")], "id long, prompt string")
    valid = spark.createDataFrame([(2,), (2,), (5,)], "id long")
    rows = J.prepare(targets, valid, "id", F.col("prompt"), 100, "plain").orderBy("id").collect()
    assert [r.id for r in rows] == [1, 3, 4, 6, 7] and json.loads(rows[1].value) == {"custom_id": "3", "prompt": "ppp"}
    sizes = {}
    for r in rows:
        sizes[r.batch] = sizes.get(r.batch, 0) + len(r.value) + 1
    assert max(sizes.values()) <= 100 and len(sizes) > 1 and [r.batch for r in rows] == sorted(r.batch for r in rows)
    assert J.prepare(targets.limit(0), valid, "id", F.col("prompt"), 100).count() == 0
