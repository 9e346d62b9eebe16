import corpus_pipeline
from pyspark.sql import functions as F


def test_texts_stay_without_labels(spark, docs_of):
    docs = docs_of(["plain words", "12 34 --", None, "", "été", "a"]).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in kept.collect()} == {0, 4, 5}
