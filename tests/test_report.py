import datetime
import json

from glossmark.operators import prices
from glossmark.operators import report as R
from glossmark.plans import reports

D = datetime.date


def docs(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, day date, lang string")


def found(spark, rows, words):
    hits = R.document_hits(docs(spark, rows), words, ["day", "lang"])
    return R.sections(hits, {"lang": "lang"})


def test_sections_by_hand(spark):
    rows = [(1, "aa b", D(2024, 1, 1), "en"), (2, "a", D(2024, 1, 3), None), (3, None, None, "en"), (4, "", D(2024, 1, 2), "fr"), (4, "", D(2024, 1, 2), "fr")]
    got = {(r.section, r.name, r.part): (r.episodes, r.hits, r.place) for r in found(spark, rows, {"t": {"x": ["a", "b"], "y": ["zz"]}}).collect()}
    assert got == {
        ("all", "", ""): (5, 4, 1), ("all_lang", "", "en"): (2, 3, 1), ("all_lang", "", "unknown"): (1, 1, 2), ("all_lang", "", "fr"): (2, 0, 3),
        ("t", "x", ""): (2, 4, 1), ("t_lang", "x", "en"): (1, 3, 1), ("t_lang", "x", "unknown"): (1, 1, 2),
    }


def test_empty_corpus(spark):
    none = found(spark, [], {"t": {"x": ["a"]}})
    assert none.count() == 0 and R.memory(none, ["lang"]).count() == 0
    assert [r.value.splitlines()[0] for r in R.markdown(none, {"t": "T"}, 3).collect()] == ["## T"]


def test_memory_and_markdown(spark):
    rows = [(i, "a" * i, D(2024, 1, i), "en" if i % 2 else "fr") for i in range(1, 5)]
    got = found(spark, rows, {"t": {"x": ["a"]}})
    memory = {r.name: json.loads(r.memory) for r in R.memory(got, ["lang"]).where("kind = 't'").collect()}
    assert memory == {"x": {"episodes": 4, "hits": 10, "first_day": "2024-01-01", "last_day": "2024-01-04", "lang": [{"part": "en", "episodes": 2, "hits": 4}, {"part": "fr", "episodes": 2, "hits": 6}]}}
    (table,) = R.markdown(got, {"t_lang": "By language"}, 1).collect()
    assert table.value.splitlines()[-1] == "| x | fr | 2 | 6 |"


def test_days_are_filled(spark):
    bars = spark.createDataFrame([("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 3), 2.0), ("a", D(2024, 2, 1), 9.0), ("b", D(2024, 1, 4), 5.0)], "symbol string, d date, close double")
    rows = prices.daily(bars, "2024-01-04").collect()
    assert sorted((r.symbol, r.day.day, r.close) for r in rows) == [("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, 2.0), ("a", 4, 2.0), ("b", 4, 5.0)]


def test_one_scan_of_the_documents(spark, small):
    plan = reports.corpus_report(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Aggregate") <= 3
