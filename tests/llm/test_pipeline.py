import re
import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from test_others import classes_of, removed, split
from tokenizers import Tokenizer


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    texts = {i: t for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
    assert seen["language id"] == texts
    least = {}
    for i in sorted(texts):
        least.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", texts[i]), i)
    texts = {i: texts[i] for i in least.values()}
    assert seen["exact dedup"] == texts
    texts = {i: texts[i] for i, c in classes_of(texts).items() if i == c}
    assert seen["near dedup"] == texts
    cut = removed(texts)
    assert set(seen["substring dedup"]) == {i for i in texts if cut[i][0] > cut[i][1]}
    assert all(seen["substring dedup"][i] == texts[i] if not cut[i][1] else len(split(seen["substring dedup"][i])) == cut[i][0] - cut[i][1] for i in seen["substring dedup"])
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {i: len(word.encode(t, add_special_tokens=False).ids) + 1 for i, t in seen["substring dedup"].items()}
    found = Counter()
    for r in rows:
        found[r.doc_id] += r.length
    assert found == sizes
    assert len({zlib.crc32(str((r.sequence_id, r.offset)).encode()) for r in rows}) == len(rows)


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0


def staged(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()


def test_edges_of_all_stages(spark, docs_of):
    """Nulls in any column, empty and long texts, repeated rows and ids, columns with clashing names."""
    words = " ".join(f"w{i}" for i in range(60))
    near_one, near_two = words + " tail", words + " other"
    texts = [None, "", "12 34", words, words, words + "  ", near_one, near_two, "short text", "long " * 40_000, "apart alone here", "apart alone here"]
    ids = [1, 2, 3, 4, 4, 5, 6, None, None, 9, 6, None]
    docs, packed = staged(spark, docs_of(texts, ids, clash=True))
    found = Counter((r.doc_id, r.text) for r in docs.collect())
    # one of the equal rows of id 4 stays, and of its near copies none; the row that shares id 6 with a near copy stays, as does the short text
    assert found == {(4, words): 1, (None, "short text"): 1, (9, "long " * 40_000): 1, (6, "apart alone here"): 1}
    assert sum(r.length for r in packed if r.doc_id == 9) == 40_001
    nulls = docs_of(texts, ids).selectExpr("doc_id", "text", "cast(null as string) AS lang", "cast(null as string) AS source", "cast(null as bigint) AS n_chars")
    assert Counter((r.doc_id, r.text) for r in staged(spark, nulls)[0].collect()) == found


def test_empty_table(spark, docs_of):
    docs, packed = staged(spark, docs_of(["x"]).where("false"))
    assert docs.count() == 0 and packed == []


def test_one_python_call_a_row(spark, docs_of):
    """A stage's last step has one Python node: with two in a task, each executor holds twice the Python workers from then on."""
    words = " ".join(f"w{i}" for i in range(40))
    docs = docs_of([words, words + " tail", "apart alone"])
    for name, stage in corpus_pipeline.STAGES:
        plan = stage(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") <= 1, name
    assert {r.doc_id: r.text for r in corpus_pipeline.substrings(spark, docs, "").collect()} == {0: words, 1: "tail", 2: "apart alone"}
