"""From raw documents to packed token sequences: five stages, each working on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.llm import dart_minhash, exact_dedup, langid, packing, substring
from glossmark.llm.common import bloom_blocks, bloom_filter, bloom_probe, kept, scratch_scope, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: null texts and texts without a letter. The same where no row has a label to learn from."""
    model = langid.fit(docs)
    if not model.languages:
        model = langid.unlabelled()
    return langid.identify(docs, model).where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the one with the smallest doc_id stays."""
    return exact_dedup.exact_dedup(exact_dedup.with_digest(docs)).where("kept").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest doc_id stays; null ids come last.

    Rows are told apart by doc_id and text together, so a row that shares only its doc_id with a dropped copy stays. Rows that
    are alike in both are exact copies, which the stage before has removed; here they stay or go together."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))
    classes = dart_minhash.near_duplicates(docs.select(row.alias("row"), "text"), "row")
    dropped = written(classes.where(~F.col("kept")).select("row.doc_id", "row.text_hash").distinct(), "near-copies")
    # Only rows that a Bloom filter takes for dropped ones are shuffled to make sure; the rest pass straight through.
    hashed = dropped.select(F.xxhash64("doc_id", "text_hash").alias("row__"))
    blocks = bloom_blocks(dropped.count(), 16)
    filter_ = written(bloom_filter(hashed, "row__", blocks, 2), "near-copies-filter")
    told = docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash__"), F.xxhash64("doc_id", F.xxhash64("text")).alias("row__"))
    probed = bloom_probe(told, "row__", filter_, blocks, 2, "maybe__")
    sure = probed.where(~F.col("maybe__")).select(*COLUMNS)
    gone = dropped.select(F.col("doc_id").alias("gone__"), F.col("text_hash").alias("gone_hash__"))
    left = probed.where("maybe__").join(gone, F.col("doc_id").eqNullSafe(F.col("gone__")) & (F.col("text_hash__") == F.col("gone_hash__")), "left_anti")
    return sure.unionByName(left.select(*COLUMNS))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out words in passages that an earlier document has; a text without such words stays as it is. Texts left empty go."""
    cut = substring.remove_repeats(docs.select(*COLUMNS)).withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return cut.where("n_removed < n_words").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", language_id),
    ("exact dedup", exact),
    ("near dedup", near),
    ("substring dedup", substrings),
    ("best-fit packing", pack),
]

#: No SQL: tokenizer ids and learned languages are beyond it; tests/llm hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark):  # the tables on a stage's way go once its result is written
            docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
