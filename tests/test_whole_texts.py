"""Queries over whole texts against plain Python: what lies behind the prefixes counts."""

import pytest

from glossmark import plans, registry  # noqa: F401

DOCS = [
    (1, "x" * 130 + " tion, Eau;" + "y" * 3000 + " sch|que", "en", "src1", 3150),
    (2, "z" * 250 + " ou ion; the end, TODAY, today", "de", "src2", 280),
    (3, "tion, tion;Tion| ;" + "w" * 200 + ",Last", "fr", "src3", 225),
    (4, "", "es", "src0", 0),
    (5, "a" * 39 + "the" + "b" * 300 + " src1", "en", "src4", 347),
    (6, "eau ou ou" + " " * 120 + "today", "fr", "src5", 134),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    turns = [(7, 1, "user", "b" * 50 + " end"), (7, 0, "assistant", "first of all the words"), (8, 3, "user", "short")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at


def rows(spark, tables, name):
    return {r[0]: tuple(r[1:]) for r in registry.queries()[name](spark, tables).collect()}


def test_headlines(spark, tables):
    def classed(text):
        s = f"{text[:40]} {text}"
        up, down, risk = (sum(map(s.count, words)) for words in (["tion", "ing"], ["eau", "sch"], ["ou", "ion"]))
        direction = "risk_control" if risk >= 2 and down else "mixed" if up and down else "bullish" if up else "bearish" if down else "unknown"
        horizon = "intraday" if "today" in s else "monthly" if "que" in s else "multi_month" if "the" in s else "swing"
        return direction, horizon, "low" if direction == "unknown" else "medium"

    found = rows(spark, tables, "headline_class_whole")
    assert found == {d[0]: classed(d[1]) for d in DOCS}
    assert found[1][:2] == ("mixed", "monthly") and found[2][1] == "intraday"


def test_keywords(spark, tables):
    def words(text):
        found = [w.strip(" ") for w in text.replace(";", ",").replace("|", ",").split(",")]
        return ("|".join(w.lower() for w in dict.fromkeys(found) if w),)

    assert rows(spark, tables, "hashtags_keywords_whole") == {d[0]: words(d[1]) for d in DOCS}


def test_relevance(spark, tables):
    def scored(text, source):
        score = sum(w for term in ("the", "src1") for field, w in ((text[:40], 3), (text[40:], 2), (source, 1)) if term in field.lower())
        return score, source == "src3" or score >= 2

    found = rows(spark, tables, "author_relevance_whole")
    assert found == {d[0]: scored(d[1], d[3]) for d in DOCS}
    assert found[2] == (2, True) and found[5] == (2, True)


def test_payload(spark, tables):
    found = rows(spark, tables, "conversation_payload_whole")
    assert found[7][2] == "[assistant] first of all the words\n[user] " + "b" * 50 + " end"
    assert found[8][2] == "[user] short"


def test_notes_take_whole_headlines(spark, small):
    whole = rows(spark, small, "headline_class_whole")
    notes = registry.queries()["deterministic_notes_whole"](spark, small).collect()
    assert len(notes) == len(whole)
    assert all((n.direction, n.horizon, n.confidence) == whole[n.doc_id] for n in notes)
