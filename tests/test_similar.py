"""Similar and contained sets in groups of few and of many sets, which are compared pair by pair or by the index."""

import random

import pytest

from glossmark.operators import similar

SIZES = {"one": 1, "few": 9, "at": 40, "above": 41, "many": 90}


def drawn():
    draw = random.Random(3)
    sizes = [(g, i) for g, n in SIZES.items() for i in range(n)]
    return [(g, 1000 * list(SIZES).index(g) + i, list(set(draw.choices(range(25), k=draw.randint(0, 12))))) for g, i in sizes]


@pytest.mark.parametrize("direct", [0, 40, 1000])
def test_both_ways_find_the_same(spark, direct):
    sets, least = drawn(), 0.4
    df = spark.createDataFrame(sets, "g string, k long, t array<long>").repartition(3)
    alike = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x and y else 0
    got = sorted((r.g, r.a, r.b, round(r.similarity, 12)) for r in similar.similar_pairs(df, "g", "k", "t", least, direct).collect())
    assert got == sorted((g, i, j, round(alike(x, y), 12)) for g, i, x in sets for h, j, y in sets if g == h and i < j and alike(x, y) >= least)
    holders = df.where("k % 3 = 0 and g <> 'at'").withColumnRenamed("k", "h")
    held = sorted((r.g, r.k, r.h) for r in similar.contained_pairs(df, holders, "g", "k", "h", "t", least, direct).collect())
    assert held == sorted((g, i, j) for g, i, x in sets for h, j, y in sets if g == h != "at" and j % 3 == 0 and x and len(set(x) & set(y)) >= least * len(x))


def test_no_index_of_small_groups(spark):
    df = spark.createDataFrame([(f"g{i // 5}", i, [i % 7, i % 3, 100]) for i in range(500)], "g string, k long, t array<long>")
    assert similar.by_size(df, "g", similar.DIRECT)[1].count() == 0
