"""Operators on small fixtures whose results follow by hand."""

import datetime as dt

from pyspark.sql import functions as F

from glossmark.operators import greedy, humor, notes, prices, sync


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_as_of_takes_the_last_bar_on_or_before(spark):
    bars = spark.createDataFrame([("a", day(1), 10.0), ("a", day(4), 11.0), ("b", day(2), 5.0)], "symbol string, d date, close double")
    targets = spark.createDataFrame([(1, "a", day(0)), (2, "a", day(1)), (3, "a", day(3)), (4, "a", day(9)), (5, "b", day(2)), (6, "c", day(2)), (7, "a", day(900))], "id int, symbol string, target date")
    want = {1: None, 2: 10.0, 3: 10.0, 4: 11.0, 5: 5.0, 6: None, 7: 11.0}
    assert {r.id: r.close for r in prices.as_of(targets, bars).collect()} == want
    for days in (1, 2, 7, 366):
        assert {r.id: r.close for r in prices.as_of_ranged(targets, bars, days=days).collect()} == want


def test_returns_and_drawdown(spark):
    bars = spark.createDataFrame([("a", day(i), c) for i, c in enumerate([0.0, 100.0, 110.0, 99.0])], "symbol string, d date, close double")
    rows = sorted(prices.with_returns(bars).collect(), key=lambda r: r.d)
    assert [r.ret_1d_pct for r in rows] == [None, None, 10.0, -10.0]
    assert [r.ret_5d_pct for r in rows] == [None] * 4
    assert [r.drawdown_60d_pct for r in rows] == [None, 0.0, 0.0, -10.0]
    assert all(r.drawdown_60d_pct <= 0 for r in rows if r.drawdown_60d_pct is not None)


def test_regimes(spark):
    cases = [([], [], "unknown"), ([-15.0], [], "risk-off / drawdown"), ([0.0], [-25.0], "risk-off / drawdown"), ([15.0], [], "risk-on / momentum"), ([0.0], [25.0], "risk-on / momentum"), ([-7.0, 7.0], [], "weak / corrective"), ([7.0], [], "constructive / rising"), ([1.0], [], "mixed / range")]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a array<double>, b array<double>")
    found = {r.i: r.v for r in rows.select("i", prices.regime_by_returns(F.col("a"), F.col("b")).alias("v")).collect()}
    assert [found[i] for i in range(len(cases))] == [c[2] for c in cases]
    four = [(5.0, -3.0, True, "risk-on / momentum"), (5.0, -4.0, True, "mixed / range"), (-5.0, -1.0, True, "weak / corrective"), (1.0, -8.0, True, "weak / corrective"), (None, -9.0, True, "mixed / range"), (9.0, 0.0, False, "unknown")]
    rows = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(four)], "i int, r double, d double, k boolean")
    found = {r.i: r.v for r in rows.select("i", prices.regime_by_drawdown(F.col("r"), F.col("d"), F.col("k")).alias("v")).collect()}
    assert [found[i] for i in range(len(four))] == [c[3] for c in four]


def test_status_merge_deletes_and_clears(spark):
    rows = spark.createDataFrame([(1, "x", "bad"), (2, "x", "bad"), (3, "x", None), (4, "x", "bad")], "id int, status string, error string")
    status = spark.createDataFrame([(1, "done", True, None, False), (2, "", True, "", False), (3, "x", True, "new", True)], "id int, status string, has_status boolean, error string, has_error boolean")
    found = {r.id: (r.status, r.error, r.changed) for r in sync.merge_status(rows, status, "id", ["status", "error"], F.col("status") == "done", "error").collect()}
    assert found == {1: ("done", None, True), 2: (None, "bad", True), 3: ("x", "new", True), 4: ("x", "bad", False)}


def test_diff_is_exhaustive(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, s string")
    b = spark.createDataFrame([(2, "b"), (3, "x"), (4, "d")], "k int, s string")
    assert {r.k: r.change for r in sync.signature_diff(a, b, "k", "s").collect()} == {1: "removed", 3: "changed", 4: "added"}


def test_newest_target_stops_if_a_copy_is_done(spark):
    schema = "id int, day date, ts int, dedicated boolean, seconds int, full boolean, done boolean, key string"
    rows = [(1, day(1), 5, False, 90, True, False, "k"), (2, day(1), 4, True, 90, True, False, "k"), (3, day(1), 9, True, 10, False, False, "s"), (4, day(0), 99, True, 90, True, False, "k")]
    assert [r.id for r in sync.newest_target(spark.createDataFrame(rows, schema)).orderBy("id").collect()] == [1, 2]
    rows[1] = (*rows[1][:6], True, "k")
    assert sync.newest_target(spark.createDataFrame(rows, schema)).count() == 0


def test_band_join_and_nearest(spark):
    notes_ = spark.createDataFrame([("d", 1, 1000), ("d", 2, 5000)], "day string, note int, at long")
    chunks = spark.createDataFrame([("d", i, s) for i, s in enumerate([880, 879, 1150, 1151, 1000, 4830, 5171])], "day string, chunk int, seconds long")
    assert {(r.note, r.chunk) for r in humor.band_join(notes_, chunks, "day").collect()} == {(1, 0), (1, 2), (1, 4)}
    assert {(r.note, r.chunk, r.delta) for r in humor.nearest_chunk(notes_, chunks, "day", "note", "chunk").collect()} == {(1, 4, 0), (2, 5, -170)}
    assert {r.chunk for r in humor.uncovered(chunks, notes_, "day", "chunk").collect()} == {5, 6}


def test_chunks(spark):
    docs = spark.createDataFrame([("d", "before\n# 00:10 Start\nbody one\n# 12:05\nbody two\n# no time\n")], "key string, text string")
    found = [(r.timestamp, r.heading, r.body) for r in humor.chunks_of(docs, "key").orderBy("ord").collect()]
    assert found == [("00:10", "Start", "body one"), ("12:05", "", "body two\n# no time")]


def test_greedy_dedupe_depends_on_order(spark):
    """A is like B and B like C but A not like C: C joins as the cluster's text has grown by B."""
    a, b, c = "abcdefghij", "abcdefghijklmnopqrst", "klmnopqrstuvwxyz"
    rows = spark.createDataFrame([("d", 1, 1000, "", "t", a), ("d", 2, 2000, "", "t", b), ("d", 3, 0, "", "t", b), ("d", 4, 3000, "", "n", c), ("d", 5, 3010, "", "t", "zz")], "day string, id long, seconds long, heading string, kind string, text string")
    found = {r.id: r.cluster for r in greedy.greedy_dedupe(rows).collect()}

    def grams(t):
        return {t[i : i + 3] for i in range(len(t) - 2)} if len(t) > 3 else {t}

    clusters = []
    for i, s, k, t in [(1, 1000, "t", a), (2, 2000, "t", b), (4, 3000, "n", c), (5, 3010, "t", "zz"), (3, 0, "t", b)]:
        for cl in clusters:
            sim = len(grams(cl[2]) & grams(t)) / len(grams(cl[2]) | grams(t))
            if abs(cl[1] - s) <= 130 and (sim >= 0.035 or cl[3] != {k}) or sim >= 0.55:
                cl[0].append(i)
                cl[2] += t
                cl[3].add(k)
                break
        else:
            clusters.append([[i], s, t, {k}])
    assert found == {i: cl[0][0] for cl in clusters for i in cl[0]}
    assert found[5] == 4 and len(set(found.values())) < 5


def test_note_errors(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "x", 50), (3, "x", 5)], "i int, a string, b int")
    found = {r.i: r.e for r in rows.select("i", notes.errors([("b large", F.col("b") > 9)], [("no a", F.col("a").isNull())]).alias("e")).collect()}
    assert found == {1: ["no a"], 2: ["b large"], 3: []}
    sums = spark.createDataFrame([(1, [50.0, 44.0]), (2, [50.0, 45.0]), (3, [60.0, 45.0]), (4, [61.0, 45.0])], "i int, p array<double>")
    assert {r.i: r.bad for r in sums.select("i", notes.validate_percentages(F.col("p")).alias("bad")).collect()} == {1: True, 2: False, 3: False, 4: True}


def test_batches_keep_the_last_valid(spark):
    rows = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False), ("b", 2, False), ("c", 1, True), ("c", 4, True)], "k string, o int, valid boolean")
    assert {r.k: (r.o, r.valid) for r in notes.settle_batches(rows, "k", ["o"], "valid").collect()} == {"a": (2, True), "b": (2, False), "c": (4, True)}


def test_rows_without_a_day_stay(spark):
    rows = spark.createDataFrame([(1, None), (2, dt.date(2024, 1, 2))], "i int, target date")
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 1), 5.0), ("B", dt.date(2024, 1, 3), 6.0)], "symbol string, d date, close double")
    found = sorted(((r.i, r.symbol, r.close) for r in prices.as_of_days(rows, bars).collect()), key=repr)
    assert found == [(1, "A", None), (1, "B", None), (2, "A", 5.0), (2, "B", None)]


def test_places_over_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("i"), F.when(F.col("id") % 3 != 0, F.col("id") % 10).alias("k"))
    order = [F.desc_nulls_last("k"), F.asc("i")]
    found = [(r.i, r.place) for r in sync.placed(rows, order).orderBy("place").collect()]
    assert [p for _, p in found] == list(range(1, 5001))
    assert [i for i, _ in found] == [r.i for r in rows.orderBy(*order).collect()]
    assert sync.placed(rows.where("false"), order).collect() == []
