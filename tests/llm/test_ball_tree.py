"""Ranked lexical search against a plain loop over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import duck, spark_rows

from glossmark.llm import ball_tree, queries
from glossmark.llm.ball_tree import BallTree, Best, Query

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    """(item, rank, id, score) by scoring every document for every item."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            n = sum(b.values())
            m = 75 + 25 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in plain_terms(text) if b[t])
            scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, rank string, score int, row int")
    q = spark.createDataFrame([(i, t, "y", 3) for i, t in items], "item_id long, text string, doc_id string, item int")
    return sorted((tuple(r) for r in ball_tree.ranked_search(d.repartition(3), q, **kw).collect()), key=repr)


def texts(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "ÄRGER", "日本語", "x_y", "İ", "A1b", "a1B"]
    return [" ".join(draw.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=draw.randint(0, 60))) + draw.choice(["", ".", "\x00", "\x7fz"]) for _ in range(n)]


def test_equal_to_a_plain_loop_with_ties_nulls_and_repeats(spark):
    docs = list(enumerate(texts(1, 300))) + [(None, "w1 w2 w3"), (None, None), (7, "w1 w2 w3"), (7, "w1 w2 w3"), (900, ""), (901, " ... ")] + [(1000 + i, "w5 w6 copies copies") for i in range(40)]
    items = list(enumerate(texts(2, 12))) + [(100, None), (101, "copies w5 copies"), (102, "unseen words"), (103, "w1 " * 500)]
    assert found(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "w1")]) == [] == found(spark, [(1, "w1")], [])
    assert found(spark, [(1, None), (2, "!")], [(1, "w1")]) == []


def test_items_in_several_groups_and_small_blocks(spark, monkeypatch):
    docs, items = list(enumerate(texts(3, 200))), list(enumerate(texts(4, 15)))
    monkeypatch.setattr(ball_tree, "QUERY_BYTES", 400)
    monkeypatch.setattr(ball_tree, "BLOCK_DOCS", 50)
    assert found(spark, docs, items, k=5) == plain(docs, items, 5)


def test_a_very_long_document(spark):
    docs = [(1, "w1 w2 " * 300_000), (2, "w1"), (3, "w2 w9")]
    assert found(spark, docs, [(1, "w1 w9")]) == plain(docs, [(1, "w1 w9")])


@pytest.mark.parametrize("n", [1, 2, 31, 33, 500])
def test_no_document_is_above_its_nodes_bound_and_subtrees_are_left_out(n):
    draw = np.random.default_rng(n)
    terms, groups = 40, 8
    topic = np.sort(draw.integers(0, 5, n))  # each topic has terms of its own
    dense = np.where((np.arange(terms)[None, :] % 5 == topic[:, None]) & (draw.random((n, terms)) < 0.6), draw.integers(1, 999_999, (n, terms)), 0)
    dense[:, 0] = np.maximum(dense[:, 0], 1)
    rows, cols = np.nonzero(dense)
    group_of = np.arange(terms) * groups // terms
    tree = BallTree(rows, cols, dense[rows, cols], np.arange(n), terms, group_of, groups)
    assert (tree.dense == dense[tree.ids]).all()
    query = Query(np.arange(1, terms, 5), draw.integers(1, 20_000, len(range(1, terms, 5))), group_of, groups)
    scores, bounds = tree.dense[:, query.terms].astype(np.int64) @ query.weights, tree.upper_bounds(query)
    at = 0
    for ends in tree.bounds_at:
        for a, b in zip(ends, ends[1:], strict=False):
            assert scores[a:b].max() <= bounds[at]
            at += 1
    best = Best(3)
    scored = tree.search(query, best)
    assert best.scores.tolist() == sorted(scores[scores > 0].tolist(), reverse=True)[:3]
    assert scored < n or n < 500


def test_impacts_are_exact_above_64_bits():
    tf, length = np.array([3], np.int64), np.array([10**9], np.int64)
    assert ball_tree.impacts(tf, length, 10**12, 10**15).tolist() == [10**9 * 3 // (3000 + 12 * (75 + 25 * 10**9 * 10**12 // 10**15))]


def test_query_equals_sql(spark, small):
    assert spark_rows(queries.op11_ranked_search(spark, small)) == duck(small, queries.OP11_SQL)
