"""The automaton against a regular expression for each alias."""

import random
import re
import time

from glossmark.operators import automaton, mentions

TEXTS = [None, "", "AAPL rose, aapl_x fell", "xAAPL AAPLé éAAPL", "台積電和AAPL", "a.b c+d (e)", "İstanbul ISTANBUL ıstanbul", "Kelvin ſet SET", "ab abc abcd abcde", "ab" * 50_000 + " end"]
ALIASES = [("apple", "AAPL"), ("apple", "aapl"), ("tsmc", "台積電"), ("x", "a.b"), ("x", "c+d"), ("y", "set"), ("k", "kelvin"), ("i", "istanbul"), ("s", "ab"), ("s", "abc"), ("s", "bcd"), ("s", "abcde"), ("e", "end"), ("n", ""), ("both", "積電和aapl")]


def plain(texts, aliases):
    found = set()
    for i, t in enumerate(texts):
        for s, a in aliases:
            body = re.escape(automaton.fold(a))
            pattern = rf"(?<![A-Za-z0-9_]){body}(?![A-Za-z0-9_])" if a.isascii() else body
            if a and t and any(True for _ in re.finditer(pattern, automaton.fold(t))):
                found.add((i, s, a))
    return found


def test_equal_to_patterns_and_to_parts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    table = spark.createDataFrame([*ALIASES, (None, "end"), ("e", None)], "symbol string, alias string")
    want = plain(TEXTS, ALIASES)
    assert {tuple(r) for r in automaton.table_hits(docs, table).collect()} == want
    hits = automaton.table_hits(docs, table, max_bytes=40).collect()
    assert {tuple(r) for r in hits} == want and len(hits) == len(want)
    assert automaton.table_hits(docs, table.limit(0)).collect() == [] == automaton.table_hits(docs.limit(0), table).collect()


def test_few_aliases_and_many_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if i not in (6, 7)], "i int, text string")
    few = {tuple(r) for r in mentions.alias_hits(docs, ALIASES[:13]).collect()}
    monkeypatch.setattr(mentions, "INLINE_ALIASES", 0)
    assert {tuple(r) for r in mentions.alias_hits(docs, ALIASES[:13]).collect()} == few


def test_time_hardly_depends_on_the_number_of_aliases():
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(5, 12))) for _ in range(50_000)]
    text = " ".join(draw.choices(words, k=40_000)) + " 日本"
    took = {}
    for n in (50, 50_000):
        matcher = automaton.Matcher([("s", w) for w in words[:n]])
        began = time.process_time()
        found = matcher(text)
        took[n] = time.process_time() - began
        inside = {w for w in words[:n] if f" {w} " in f" {text} "}
        assert {words[i] for i in found} == inside
    assert took[50_000] < 20 * took[50] + 0.5  # a thousand times the aliases; hits themselves take time
