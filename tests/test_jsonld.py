import json

from pyspark.sql import functions as F

from glossmark.functions import jsonld

PAGE = """<html><head><meta property="og:description" content="from meta"><script type="application/ld+json">{"@graph": [{"@type": "Person", "name": "n"},
{"@type": ["NewsArticle"], "headline": "Head\tline", "author": [{"@type": "Person", "name": "A"}], "keywords": ["x", "y"], "datePublished": "2024-01-02"}]}</script>
<script type="application/ld+json">{broken</script></head></html>"""


def test_article(spark):
    rows = spark.createDataFrame([(0, PAGE), (1, "<p>none</p>"), (2, None)], "i int, html string")
    found = {r.i: r.a for r in rows.select("i", jsonld.article(F.col("html")).alias("a")).collect()}
    a = found[0]
    assert (a.title, a.description, a.date_published, a.author, a.keywords) == ("Head line", "from meta", "2024-01-02", "A", ["x", "y"])
    assert (a.genre, a.image_url, a.url) == (None, None, None)
    assert found[1].title is None and found[2].title is None


def test_walk_keeps_document_order():
    value = json.loads('[{"a": {"b": {}}, "c": [{"d": 1}]}, {"e": {}}]')
    assert [sorted(x) for x in jsonld.walk(value)] == [["a", "c"], ["b"], [], ["d"], ["e"], []]
