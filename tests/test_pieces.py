"""Python functions of columns: what a worker holds of a batch, and that results keep their rows."""

import tracemalloc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from glossmark.functions import html as H
from glossmark.functions import text as T
from glossmark.functions.pieces import in_pieces


def test_few_values_of_a_batch_are_objects_at_a_time():
    batch = pa.array([f"{i} " + "é" * 20_000 for i in range(2_000)], pa.string())
    tracemalloc.start()
    rows = sum(len(x) for x in in_pieces(iter([batch]), lambda t: t + "!", pa.string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2_000 and peak < 8 << 20


def test_results_keep_their_rows(spark):
    texts = [None if i % 7 == 0 else f"<p>ﬁ {i}</p>" for i in range(3_000)] + [""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    found = {r.i: r for r in rows.select("i", T.nfkc_lower(F.col("t")).alias("n"), H.html_to_text(F.col("t")).alias("h")).collect()}
    assert [found[i].n for i in range(len(texts))] == [t and t.replace("ﬁ", "fi") for t in texts]
    assert [found[i].h for i in range(len(texts))] == [t and f"ﬁ {i}" for i, t in enumerate(texts)]
    # no batch is handed over whole: both are functions of an iterator of batches
    assert {T._nfkc.evalType, H.html_to_text.evalType} == {F.arrow_udf(in_pieces_like, "string").evalType}


def in_pieces_like(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return batches
