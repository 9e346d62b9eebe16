"""Phrases against counts over plain lists; the trie and its runs against a dict."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import duck, spark_rows

from glossmark.llm import hat_trie, queries
from glossmark.llm.hat_trie import HatTrie, Runs


def plain(docs, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score)."""
    counts = {}
    for lang, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        of = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            of.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        rows = []
        for p, a in f.items():
            if len(p) > 1 and a >= least and not any(len(q) > len(p) and c >= least and 100 * c >= 50 * a and p in (q[:2], q[1:]) for q, c in f.items() if len(q) == 3 and p[0] in q):
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def found(spark, docs, **kw):
    df = spark.createDataFrame([(t, lang, "x", 1) for lang, t in docs], "text string, lang string, word string, n int").repartition(3)
    return sorted(tuple(r) for r in hat_trie.phrases(df, **kw).collect())


def texts(seed, n, words=30):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["New York", "the", "Éa", "\x1cx", "x\x00y"]
    weights = [1 / (i + 1) for i in range(words)] + [2, 4, 0.3, 0.2, 0.2]
    return [(draw.choice(["en", "en", "fr", None, "und"]), draw.choice([" ", "  ", "\t", ""]).join([]) + "".join(w + draw.choice([" "] * 9 + [", ", "\n", "\t", "!"]) for w in draw.choices(vocabulary, weights, k=draw.randint(0, 80)))) for _ in range(n)]


def test_equal_to_plain_counts(spark):
    docs = texts(1, 150) + [("en", None), (None, None), ("de", ""), ("fr", "a a a a a a a a a a a a a"), ("xx", "... !!")] + [("en", "Copy of A copy")] * 12
    assert found(spark, docs) == plain(docs)
    assert found(spark, docs, least=2, top=7) == plain(docs, 2, 7)


def test_spills_bursts_hot_words_and_many_partitions(spark, monkeypatch):
    docs = texts(2, 120)
    for name, value in (("SPILL_ENTRIES", 60), ("BURST_ENTRIES", 5), ("PARTITION_WINDOWS", 200), ("HOT_SHARE", 1 / 20)):
        monkeypatch.setattr(hat_trie, name, value)
    assert found(spark, docs, least=3) == plain(docs, 3)


def test_empty_table_and_one_word(spark):
    assert found(spark, []) == [] == found(spark, [("en", "word")] * 30)


def test_a_very_long_text(spark):
    docs = [("en", "one two three. " * 60_000)]
    assert found(spark, docs) == plain(docs)


def test_another_seed_where_ids_clash(spark, monkeypatch):
    docs = texts(3, 40)
    real = hat_trie.word_id
    monkeypatch.setattr(hat_trie, "word_id", lambda lang, word, seed: 5 if seed == 42 else real(lang, word, seed))
    assert found(spark, docs, least=3) == plain(docs, 3)


@pytest.mark.parametrize("burst", [1, 3, 1000])
def test_trie_counts_what_a_dict_counts(burst, monkeypatch):
    monkeypatch.setattr(hat_trie, "BURST_ENTRIES", burst)
    draw, trie, want = np.random.default_rng(burst), HatTrie(), Counter()
    for _ in range(5):
        first, second, third = (draw.integers(0, 9, 300).astype(np.uint32) for _ in range(3))
        trie.add(first, second, third)
        want.update(zip(first.tolist(), second.tolist(), third.tolist(), strict=True))
    assert trie.entries == len(want)
    entries = trie.drained()
    assert dict(zip(zip(*(x.tolist() for x in entries[:3]), strict=True), entries[3].tolist(), strict=True)) == want
    assert not trie.root
    part = hat_trie.prefix_part(*entries[:3], np.array([2, 5], np.uint64), 7)
    order = np.lexsort((*entries[2::-1], part))
    rows = [dict(zip(("part", *Runs.NAMES), r, strict=True)) for r in Runs.of(part[order], *(x[order] for x in entries))]
    assert len({r["part"] for r in rows}) == len(rows) <= 7
    again = [np.concatenate(x) for x in zip(*map(Runs.entries, rows), strict=True)]
    assert dict(zip(zip(*(x.tolist() for x in again[:3]), strict=True), again[3].tolist(), strict=True)) == want


def test_a_hot_prefix_is_dealt_out():
    n = 3000
    one, other = np.full(n, 2, np.uint64), np.arange(n, dtype=np.uint64)
    hot = np.array([2], np.uint64)
    for first, second, third in ((one, other, other), (one, one, other)):
        assert np.bincount(hat_trie.prefix_part(first, second, third, hot, 10)).max() < n / 5
    assert len(set(hat_trie.prefix_part(other[5:6].repeat(n), other, other, hot, 10).tolist())) == 1


def test_query_equals_sql(spark, small):
    assert spark_rows(queries.op12_phrases(spark, small)) == duck(small, queries.OP12_SQL)
