"""Queries without SQL against Python over the same texts."""

import re

from glossmark.plans import search


def test_greedy_snippets(spark, small):
    found = {}
    for r in search.snippets_greedy(spark, small).collect():
        found.setdefault(r.doc_id, set()).add((r.keyword, r.start, r.line, r.snippet))
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        taken, want = [], set()
        for k in ("eau", "sch", "tion"):
            for m in re.finditer(k, r.text, re.I):
                if len(taken) < 4 and all(abs(m.start() - t) >= 95 for t in taken):
                    taken.append(m.start())
                    piece = r.text[max(0, m.start() - 95) : m.end() + 95]
                    want.add((k, m.start(), r.text.count("\n", 0, m.start()) + 1, re.sub(r"\s+", " ", piece).strip()))
        assert found.get(r.doc_id, set()) == want
