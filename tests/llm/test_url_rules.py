"""The rules of op4_url_filter against the contract's list, word by word."""

from oracle import duck, spark_rows

from glossmark.llm import queries, url_filter

#: What the contract says, and a url that each rule alone, or as the longest, decides.
CONTRACT = {
    "com/en/": ("block", "x://h.com/en/1"),
    "example.com/en/7": ("allow", "x://example.com/en/7"),
    "net/de/": ("allow", "x://h.net/de/1"),
    "example.net/de/8": ("block", "x://example.net/de/8"),
    "org/es/": ("block", "x://h.org/es/1"),
}


def test_words_of_the_rules():
    assert {host + path: word for word, host, path in url_filter.RULES} == {rule: word for rule, (word, _) in CONTRACT.items()}


def test_each_rule_decides_with_its_word(spark):
    urls = [*(url for _, url in CONTRACT.values()), "x://example.net/de/7", "x://www.example.net/de/81", "x://net/de/", "x://h.net?de/", "a://b://net/de/1", "x://h.org/es"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = [(r.rule, r.verdict) for r in url_filter.judge_urls(rows).orderBy("page_id").collect()]
    assert found[:5] == [(rule, word) for rule, (word, _) in CONTRACT.items()]
    assert found[5:] == [("net/de/", "allow"), ("example.net/de/8", "block"), ("net/de/", "allow"), (None, "allow"), (None, "allow"), (None, "allow")]


def test_sql_has_the_same_words(spark, tmp_path):
    urls = [url for _, url in CONTRACT.values()]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    names, rows = duck(str(tmp_path), queries.oracle_sql()["op4_url_filter"])
    told = {r[names.index("rule")]: r[names.index("verdict")] for r in rows}
    assert told == {rule: word for rule, (word, _) in CONTRACT.items()}
    assert spark_rows(queries.queries()["op4_url_filter"](spark, str(tmp_path))) == (names, rows)
