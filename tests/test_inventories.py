from pyspark.sql import functions as F

from glossmark.functions import jsonld
from glossmark.functions import text as T
from glossmark.operators.sync import allowed_only
from glossmark.sources import files


def texts(spark, column, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", column(F.col("v")).alias("r"))
    return [r.r for r in rows.orderBy("i").collect()]


def test_hashtags(spark):
    got = texts(spark, T.hashtags, "#a #b#a，#c、d # #e,f", "#台股　x ##y", "", None, "no")
    assert got == [["a", "b", "c", "e"], ["台股", "y"], [], [], []]


def test_keywords(spark):
    got = texts(spark, T.split_keywords, " #a , b，,a\n#c#\t d e ", "", None, ",,")
    assert got == [["a", "b", "c", "d e"], [], [], []]


def test_loose_frontmatter(spark):
    got = texts(spark, T.frontmatter_parts, '---\na: "x"\na: \'y\'\nb:c: d --- tail\n', "---\na: 1\nno end", "--- \na: 1\n---\nz", "", None, "---\n---\n body \n---\n")
    assert [(r.meta, r.body) for r in got] == [({"a": "'y'", "b": "c: d"}, "tail"), ({}, "---\na: 1\nno end"), ({}, "--- \na: 1\n---\nz"), ({}, ""), (None, None), ({}, "body \n---")]


def test_addresses_and_ids(spark):
    schema = "url string, title string, description string, date_published string, date_modified string, author string, article_section string, genre string, keywords array<string>, image_url string, is_accessible_for_free string"
    urls = ["/story/5/77?from=x", "https://m/a/b/", "//m/q", None, "c/d.html"]
    rows = spark.createDataFrame([(i, (u, "", None, None, None, None, None, None, [], None, "true")) for i, u in enumerate(urls)], f"i int, a struct<{schema.replace(' ', ': ').replace(',: ', ', ')}>")
    got = rows.select("i", F.to_json(jsonld.record(F.col("a"), F.lit("s"), F.lit(""), F.col("i"), "https://n")).alias("r")).orderBy("i").collect()
    rest = ',"is_accessible_for_free":"true"}'
    assert [r.r for r in got] == [
        f'{{"source":"s","list_position":{i},"article_id":"{k}","url":"{u}"' + rest
        for i, (k, u) in enumerate([("77", "https://n/story/5/77?from=x"), ("b", "https://m/a/b/"), ("q", "https://m/q"), ("https-n", "https://n"), ("d.html", "https://n/c/d.html")])
    ]


def test_gate(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4), ("a", 5)], "path string, n int")
    allowed = spark.createDataFrame([("a", 9), ("a", 8), ("", 7), (None, 6)], "path string, n int")
    assert sorted(r.n for r in allowed_only(rows, allowed).collect()) == [1, 5]
    assert allowed_only(rows, None).count() == 5 and allowed_only(rows, allowed.limit(0)).count() == 0
    assert allowed_only(rows, allowed).columns == ["path", "n"]


def test_inventories(spark):
    rows = spark.createDataFrame([("", "2024-05-06T1", "T", None, "# [x](http://y) d", None, "u"), (None, None, None, "", None, None, None)], "date string, published_at string, title string, summary string, description string, article_id long, url string")
    assert [tuple(r) for r in files.article_inventory(rows, "p").collect()] == [("article", "2024-05-06", "u", "T", "p", "T # x d u"), ("article", "", "", "", "p", "")]
    bare = spark.createDataFrame([("t",)], "text_preview string")
    assert [tuple(r) for r in files.joke_inventory(bare, "p").collect()] == [("joke", "", "p", None, None, "t")]
    assert files.article_inventory(bare, "p").collect()[0].text == ""
