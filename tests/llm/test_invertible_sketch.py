"""Fingerprints against sets of paragraphs in plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from glossmark.llm import invertible_sketch, queries
from glossmark.llm.invertible_sketch import PIECE_WORDS


def pieces(text):
    return {p.rstrip(" ") for p in re.findall(rf"(?:[^\n ]+ *){{1,{PIECE_WORDS}}}", text)}


def alike(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows):
    """(id, n_chars, sha256 of the edited text, likeness to it, likeness to the next text), in order of the rows by id, descending."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(alike(text, edited), 12), round(alike(text, after), 12)))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(t, i, "x", 1, [2]) for i, t in rows], "text string, doc_id long, range string, copy int, digests array<int>").repartition(3)
    return [r.asDict() for r in invertible_sketch.fingerprints(df).collect()]


def columns(rows):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in rows), key=repr)


def texts(seed, n):
    draw = random.Random(seed)
    shared = [" ".join(draw.choices("abcdefgh", k=draw.randint(1, 60))) for _ in range(20)]
    line = lambda: draw.choice(shared) if draw.random() < 0.3 else " ".join(draw.choices(["w" + str(i) for i in range(500)] + ["é日本", "\U0001f600"], k=draw.randint(0, 60)))
    return ["\n".join(line() for _ in range(draw.randint(0, 30))) for _ in range(n)]


def test_equal_to_sets_with_nulls_ties_and_copies(spark):
    t = texts(1, 60)
    rows = [(i * 7, x) for i, x in enumerate(t)] + [(None, "no id"), (None, None), (7, t[1]), (7, "another of the same id"), (3, None), (4, ""), (5, " \n \n"), (1000, t[5]), (1001, t[5])]
    got = found(spark, rows)
    assert columns(got) == plain(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1000]["fingerprint"] == by_id[1001]["fingerprint"] == by_id[35]["fingerprint"] != by_id[0]["fingerprint"]
    assert by_id[1001]["near_next"] == 1.0


def test_one_row_two_rows_and_none(spark):
    assert found(spark, []) == []
    for rows in ([(1, "alone here")], [(1, "a b"), (2, "b c d")], [(None, None)]):
        assert columns(found(spark, rows)) == plain(rows)


def test_a_very_long_text_and_ids_at_the_ends_of_long(spark):
    draw = random.Random(5)
    long = "\n".join(str(draw.random()) for _ in range(30_000))
    rows = [(-(2**63), long), (2**63 - 1, long.replace("1", "2")), (0, "short")]
    assert columns(found(spark, rows)) == plain(rows)


@pytest.mark.parametrize("bits", [3, 5])
def test_peeling_recovers_the_difference_or_says_that_it_cannot(spark, bits):
    draw, rows = random.Random(bits), []
    for n in [0, 1, 2, 5, 12, 20, 60] * 5:
        common, a, b = ([draw.getrandbits(63) for _ in range(k)] for k in (40, n, n // 2))
        rows.append((sorted(common + a), sorted(common + b)))
    s = invertible_sketch
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    small = F.expr(s.peeled(s.subtracted(s.sketch("a", bits), s.sketch("b", bits)), bits))
    whole = F.expr(s.difference("a", "b", s.sketch("a", 3), s.sketch("b", 3)))
    failed = 0
    for a, b, peeled, parts in df.select("a", "b", small, whole).collect():
        want = (sorted(set(a) - set(b)), sorted(set(b) - set(a)))
        assert tuple(sorted(d for p in parts for d in p[i]) for i in (0, 1)) == want
        failed += peeled is None
        assert peeled is None or (sorted(peeled["more"]), sorted(peeled["less"])) == want
    assert 0 < failed < 20


def test_a_part_that_never_peels_is_compared(spark):
    low = 0x1234567  # digests that agree in all bits tables use
    rows = [([low + (i << 40) for i in range(1, 4)], [low + (1 << 40)])]
    got = spark.createDataFrame(rows, "a array<long>, b array<long>").select(F.expr(invertible_sketch._by_parts("a", "b"))).first()[0]
    assert sorted(d for p in got for d in p["more"]) == rows[0][0][1:] and not any(p["less"] for p in got)


def test_the_query_equals_the_plain_version_and_runs_no_python(spark, small):
    df = queries.op13_fingerprints(spark, small)
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = [r.asDict() for r in df.collect()]
    assert columns(got) == plain(docs)
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.9 * len(got)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("Exchange hashpartitioning") <= 2  # of the ranges' first documents alone: texts move by range
