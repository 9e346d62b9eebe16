"""Ordered deduplication by an index against comparing every row with every cluster."""

import random
from collections import defaultdict

import pytest

from glossmark.operators import greedy, similar
from glossmark.operators.greedy import Cluster, grams

SCHEMA = "day string, id long, seconds long, heading string, kind string, text string"


def by_hand(rows, limit=2400):
    """(day, id) to (cluster, size): each row with every cluster so far, in order."""
    days = defaultdict(list)
    for r in rows:
        days[r[0]].append(r)
    out = {}
    for day, own in days.items():
        clusters = []
        for _, i, seconds, heading, kind, text in sorted(own, key=lambda r: (r[2] or 999_999, r[1])):
            text, heading = text or "", heading or ""
            for c, ids in clusters:
                if c.same(grams(text), seconds, heading, kind):
                    c.text = (c.text + text)[:limit]
                    c.grams = grams(c.text)
                    c.kinds.add(kind)
                    ids.append(i)
                    break
            else:
                clusters.append((Cluster(0, i, text, seconds, heading, {kind}, grams=grams(text)), [i]))
        out |= {(day, i): (ids[0], len(ids)) for _, ids in clusters for i in ids}
    return out


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {(r.day, r.id): (r.cluster, r.cluster_size) for r in greedy.greedy_dedupe(df, **kw).collect()}


def passages(seed, n, days=3, span=4000):
    draw = random.Random(seed)
    letters = lambda k: "".join(draw.choices("abcdefghijklmnop", k=k))
    stock = [letters(draw.randint(5, 60)) for _ in range(max(4, n // 6))]
    rows = []
    for i in range(n):
        base = draw.choice(stock)
        kind = draw.random()
        text = base if kind < 0.25 else base + letters(draw.randint(1, 6)) if kind < 0.5 else base[: len(base) // 2] + draw.choice(stock) if kind < 0.7 else draw.choice([None, "", "ab", "abc"]) if kind < 0.75 else letters(draw.randint(1, 50))
        seconds = draw.choice([None, 0, draw.randint(1, 140), *[draw.randint(1, span)] * 9])
        rows.append((f"d{draw.randrange(days)}", i, seconds, draw.choice(["", None, "one heading", "one heading!", "something else"]), draw.choice("ttttn"), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_every_row_with_every_cluster(spark, seed):
    rows = passages(seed, 600, span=(4000, 200_000)[seed - 1])
    assert found(spark, rows) == by_hand(rows)


def test_limit_of_grown_texts(spark):
    rows = passages(5, 150)
    assert found(spark, rows, limit=40) == by_hand(rows, 40)


def test_what_only_the_grown_text_attracts(spark):
    """Far in time, alike to no text by itself but to two of them together."""
    a, b = "abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOP"
    rows = [("d", 1, 1000, "", "t", a), ("d", 2, 1010, "", "n", b), ("d", 3, 90_000, "", "t", a[6:] + b[:20])]
    assert max(similar_share for similar_share in (greedy.similarity(grams(rows[2][5]), grams(x)) for x in (a, b))) < greedy.ALIKE
    assert found(spark, rows) == by_hand(rows) == {("d", i): (1, 3) for i in (1, 2, 3)}


def test_copies_of_one_text_and_no_rows(spark):
    rows = [("d", i, 1000 + 300 * i, "", "t", "the same text again and again") for i in range(300)]
    assert found(spark, rows) == {("d", i): (0, 300) for i in range(300)}
    assert found(spark, []) == {}


@pytest.mark.parametrize("least", [0.3, 0.55, 1.0])
def test_similar_pairs(spark, least):
    draw = random.Random(7)
    sets = [(f"g{i % 2}", i, list(set(draw.choices(range(30), k=draw.randint(0, 12))))) for i in range(120)]
    df = spark.createDataFrame(sets, "g string, k long, t array<long>")
    got = {(r.a, r.b): round(r.similarity, 12) for r in similar.similar_pairs(df, "g", "k", "t", least).collect()}
    want = {(i, j): round(len(set(x) & set(y)) / len(set(x) | set(y)), 12) for g, i, x in sets for h, j, y in sets if g == h and i < j and x and y and len(set(x) & set(y)) / len(set(x) | set(y)) >= least}
    assert got == want and (want or least == 1.0)
    held = {(r.k, r.h) for r in similar.contained_pairs(df, df.withColumnRenamed("k", "h"), "g", "k", "h", "t", least).collect()}
    assert held == {(i, j) for g, i, x in sets for h, j, y in sets if g == h and x and len(set(x) & set(y)) >= least * len(x)}
