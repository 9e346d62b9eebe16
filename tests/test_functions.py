"""Text and time functions against Python, on texts that bring their traps."""

import datetime as dt
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from glossmark.functions import html, times
from glossmark.functions import text as T

TEXTS = ["", "plain text", "ＡＢＣ①ﬁ　x", "É é È è", "a😀b😀aaa", "line\nline two\n\nend", "aaaa", "İstanbul ΣΑΣ", "tion Tion TION action", "x　　y\t z"]


def column(spark, expr, texts=TEXTS):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expr.alias("v")).collect()
    return [r.v for r in sorted(rows)]


def test_nfkc_lower(spark):
    assert column(spark, T.nfkc_lower(F.col("t"))) == [unicodedata.normalize("NFKC", t).lower() for t in TEXTS]


def test_collapse_spaces(spark):
    assert column(spark, T.collapse_spaces(F.col("t"))) == [re.sub(r"\s+", " ", t).strip() for t in TEXTS]


@pytest.mark.parametrize("needle", ["a", "aa", "é", "😀", "tion", ""])
def test_count_literal(spark, needle):
    assert column(spark, T.count_literal(F.col("t"), needle)) == [t.count(needle) if needle else 0 for t in TEXTS]


@pytest.mark.parametrize("needle", ["a", "aa", "é", "tion", "😀"])
def test_matches_are_python_places(spark, needle):
    found = column(spark, T.matches(F.col("t"), "(?iu)" + T.literal(needle)))
    assert [[(m.start, m.match) for m in x] for x in found] == [[(m.start(), m.group()) for m in re.finditer(re.escape(needle), t, re.I)] for t in TEXTS]


def test_literal_escapes(spark):
    text = "a.b*c[d](e)|f^g$h\\i{j}+?-_"
    assert column(spark, F.regexp_count(F.col("t"), F.lit(T.literal(text))), [text, "axb"]) == [1, 0]


def test_trigrams_and_jaccard(spark):
    grams = lambda t: {t[i : i + 3] for i in range(len(t) - 2)} if len(t) > 3 else {t} if t else set()
    assert [set(x) for x in column(spark, T.trigrams(F.col("t")))] == [grams(t) for t in TEXTS]
    found = column(spark, T.jaccard(T.trigrams(F.col("t")), T.trigrams(F.lit("plain next"))))
    want = [len(grams(t) & grams("plain next")) / len(grams(t) | grams("plain next")) if t else 0.0 for t in TEXTS]
    assert found == pytest.approx(want)


def test_markdown(spark):
    text = "---\ntitle: x\n---\n# Head\n- item [link](http://a.b/c) more\n* star https://x.y/z end"
    assert column(spark, T.plain_markdown(F.col("t")), [text, "no front"]) == ["Head item link more star end", "no front"]


def test_frontmatter(spark):
    found = column(spark, T.frontmatter_map(F.col("t")), ['---\ntitle: "A: b"\ndate: 2020-01-02\n---\nbody: no', "none"])
    assert found == [{"title": "A: b", "date": "2020-01-02"}, {}]


def test_spaced_hits(spark):
    hits = T.spaced_hits(T.matches(F.col("t"), "a"), 3, 2)
    assert [[m.start for m in x] for x in column(spark, hits, ["a.a.a.a.a", "aaaaaaaaaa", "b"])] == [[0, 4], [0, 3], []]


def test_alias_boundaries(spark):
    texts = ["the TSM rose", "TSMC rose", "_TSM", "TSM台", "台積電漲"]
    assert column(spark, F.col("t").rlike(T.alias_pattern("tsm")), texts) == [True, False, False, True, False]
    assert column(spark, F.col("t").rlike(T.alias_pattern("台積")), texts) == [False, False, False, False, True]


def test_earliest_snippet_and_fence(spark):
    assert column(spark, T.earliest_snippet(F.col("t"), ["bb", "aa"], 2), ["xxxxaabbyyyy", "none"]) == ["...xxaabb...", ""]
    assert column(spark, T.unfenced(F.col("t")), ['```json\n{"a": 1}\n```', "plain"]) == ['{"a": 1}', "plain"]


def test_durations(spark):
    assert column(spark, times.duration_seconds(F.col("t")), ["90", "1:30", "1:02:03", "x", "1:2:3:4", ""]) == [90, 90, 3723, None, None, None]
    assert column(spark, times.clock(F.col("t").cast("long")), ["0", "3723", "90061"]) == ["00:00:00", "01:02:03", "25:01:01"]


def test_published_local(spark):
    texts = ["2024-01-01T20:00:00Z", "2024-01-01", "2024-01-01 13:35:00", "2024/01/01 13:34", "2024-01-01T10:00:00+08:00", "junk", "1704110400"]
    want = [dt.datetime(2024, 1, 2, 4), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 13, 35), dt.datetime(2024, 1, 1, 13, 34), dt.datetime(2024, 1, 1, 10), None, dt.datetime(2024, 1, 1, 20)]
    assert column(spark, times.published_local(F.col("t")), texts) == want


def test_market_target(spark):
    local = F.to_timestamp("t").cast("timestamp_ntz")
    day, label = times.market_target(local)
    texts = ["2024-01-02 13:34:59", "2024-01-02 13:35:00", "2024-01-02 00:00:00"]
    assert column(spark, day, texts) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 1)]
    assert column(spark, label, texts) == ["prior_close", "same_day_close", "prior_close"]


def test_feed_time(spark):
    found = column(spark, times.feed_time(F.col("t")), ["Mon, 01 Jan 2024 20:00:00 GMT", "no"])
    assert found[1] is None and found[0] is not None


def test_html():
    page = "<html><style>x</style><nav>menu</nav><h2>A &amp; b</h2><p>one<br>two <a href='/x'>go</a></p><div class='share-box'>noise<div>more</div></div><p>end</p><script>y</script></html>"
    assert html.read(page, html.PAGE) == "## A & b\n\none\ntwo go\n\nnoise\nmore\n\nend"
    assert html.read(None, html.PAGE) is None and html.read("", html.PAGE) == "" and html.read("<p>broken <b>x", html.PAGE) == "broken x"
