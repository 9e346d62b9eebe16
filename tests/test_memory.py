"""Memories brought through differences against memories built anew."""

import random

from pyspark.sql import functions as F

from glossmark.operators import memory
from glossmark.operators.sync import signature_diff


def contributions(hits):
    parts = {"theme": (F.col("theme"), F.lit("")), "word": (F.col("theme"), F.col("word")), "kind": (F.col("kind"), F.lit(None))}
    return memory.contributions(hits, "doc", parts)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("part", "k1", "k2", "docs", "hits").collect())


def test_three_differences_equal_a_rebuild(spark):
    draw = random.Random(1)
    version = {}
    hits_of = lambda v: spark.createDataFrame([(d, *h) for d, hs in v.items() for h in hs], "doc long, theme string, word string, kind string, n long")
    signed = lambda v: spark.createDataFrame([(d, str(hs)) for d, hs in v.items()], "doc long, s string")
    some = lambda: [(draw.choice("abc"), draw.choice("xyz"), draw.choice(["p", None]), draw.randint(1, 9)) for _ in range(draw.randint(0, 5))]
    now, kept, versions = None, None, []
    for step in range(4):
        after = {d: hs for d, hs in version.items() if draw.random() > 0.2}
        after |= {d: some() for d in [*after, *range(step * 30, step * 30 + 30)] if draw.random() < 0.5}
        if step == 3:
            after = {d: [h for h in hs if h[0] != "a"] for d, hs in after.items()}  # a heading that nobody has any more goes
        fresh = contributions(hits_of(after))
        if now is None:
            now, kept = memory.memory(fresh), fresh
        else:
            changes = signature_diff(signed(version), signed(after), "doc", "s")
            now, kept = memory.updated(now, kept, changes, fresh)
            now, kept = (spark.createDataFrame(x.collect(), x.schema) for x in (now, kept))
        version = after
        versions.append(rows_of(now))
        assert versions[-1] == rows_of(memory.memory(fresh))
        assert sorted(map(tuple, kept.select(*fresh.columns).collect())) == sorted(map(tuple, fresh.collect()))
    assert not any(r[:2] == ("theme", "a") for r in versions[-1]) and any(r[:2] == ("theme", "a") for r in versions[-2])


def test_the_same_difference_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, "theme", "a", "", 5), (2, "theme", "a", "", 1)], "doc long, part string, k1 string, k2 string, n long")
    new = spark.createDataFrame([(1, "theme", "b", "", 2), (3, "theme", "a", "", 7)], old.schema)
    changes = spark.createDataFrame([(1, "changed"), (2, "removed"), (3, "added")], "doc long, change string")
    once = memory.updated(memory.memory(old), old, changes, new)
    assert rows_of(once[0]) == [("theme", "a", "", 1, 7), ("theme", "b", "", 1, 2)]
    assert rows_of(memory.updated(*once, changes, new)[0]) == rows_of(once[0])
    assert sorted(map(tuple, memory.section(once[0], "theme", "theme", None, "d", "h", ["a", "b", "c"]).collect())) == [("a", 1, 7), ("b", 1, 2), ("c", 0, 0)]
