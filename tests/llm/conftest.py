import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts; with clash, also columns named like what operators add or use inside."""

    def make(texts, ids=None, clash=False, langs=None):
        rows = [(i, t, (langs or {}).get(i, "en"), "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
        df = spark.createDataFrame(rows, SCHEMA)
        if clash:
            names = ["keep_id", "kept", "group_size", "text_sha256", "lang_pred", "score", "mixture", "n_words", "n_removed", "kept_text", "key__", "bloom_block", "bloom_map", "may_repeat", "sequence_id", "offset", "nth", "id", "ids", "node"]
            df = df.withColumns({n: F.lit("clash") for n in names})
        return df

    return make
