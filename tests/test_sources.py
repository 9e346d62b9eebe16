"""Sources, sinks and streams on small files written here."""

import json

import pytest
from pyspark.sql import functions as F

from glossmark.sources import files, paged, sinks
from glossmark.streaming import status


def test_jsonl_strict_and_permissive(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1, "v": "x"}\nnot json\n[1]\n\n{"k": 1, "v": "y"}\n')
    path, schema = str(tmp_path / "a.jsonl"), "k int, v string"
    assert [r.v for r in files.read_jsonl(spark, path, schema).where("k = 1").orderBy("v").collect()] == ["x", "y"]
    assert {r.line for r in files.bad_lines(spark, path).collect()} == {"not json", "[1]"}
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_jsonl(spark, path, schema, strict=True).collect()
    assert [r.v for r in files.read_keyed(spark, path, schema, "k", "v").where("k = 1").collect()] == ["y"]


def test_corpus_and_manifest(spark, tmp_path):
    (tmp_path / "2024-01-02 talk.md").write_text("---\ntitle: T\n---\n# Head\nbody [l](http://x)")
    (tmp_path / "EP001.md").write_text("# A\ntext")
    (tmp_path / "skip.txt").write_text("no")
    rows = {r.file: r for r in files.read_corpus(spark, str(tmp_path), "talks").collect()}
    assert set(rows) == {"2024-01-02 talk.md", "EP001.md"}
    assert rows["2024-01-02 talk.md"].date == "2024-01-02" and rows["2024-01-02 talk.md"].text == "Head body l" and rows["EP001.md"].date == "EP001"
    manifest = spark.createDataFrame([(1, "EP001.md"), (2, "gone.md")], "number int, local_path string")
    assert [(r.number, r.text) for r in files.via_manifest(manifest, files.read_corpus(spark, str(tmp_path), "t")).collect()] == [(1, "A text")]


RSS = """<rss xmlns:itunes="http://www.itunes.com/dtds/podcast-1.0.dtd"><channel><item><title> One  two </title><description>&lt;p&gt;Hi &lt;b&gt;there&lt;/b&gt;&lt;/p&gt;</description>
<pubDate>Mon, 01 Jan 2024 20:00:00 GMT</pubDate><guid>ab-12</guid><itunes:duration>1:02:03</itunes:duration><itunes:keywords>x, y，x</itunes:keywords><enclosure url="http://a/b.mp3" length="5" type="audio/mpeg"/></item></channel></rss>"""


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(RSS)
    row = files.read_feed(spark, str(tmp_path / "feed.xml")).first()
    assert (row.title, row.description_text, row.local_date, row.audio_url, row.duration_seconds) == ("One two", "Hi there", "2024-01-02", "http://a/b.mp3", 3723)
    assert row.episode_id == "2024-01-02-ab12" and row.keywords == ["x", "y"]


def test_video_feed(spark, tmp_path):
    (tmp_path / "v.xml").write_text('<feed xmlns:yt="u" xmlns:media="m"><entry><yt:videoId>v1</yt:videoId><title>T</title><link href="http://v"/><media:group><media:description>intro\n00:00 Start\n1:02:03 Late part</media:description></media:group></entry></feed>')
    row = files.read_video_feed(spark, str(tmp_path / "v.xml")).first()
    assert row.video_id == "v1" and row.url == "http://v" and [(c.at, c.title) for c in row.chapters] == [("00:00", "Start"), ("1:02:03", "Late part")]


def test_tree(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    nodes = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d")], "id int, parent int, name string")
    assert {r.path for r in files.flatten_tree(spark, nodes).collect()} == {"a", "a/b", "a/b/c", "d"}


def test_paged_source_retries_and_keeps_errors(spark):
    def fetch(page):
        if page == 2:
            raise ValueError("gone")
        return [(page * 10, f"p{page}")]

    rows = paged.read_pages(spark, paged.paged_source("paged_test", "id int, name string", fetch, retries=2, wait_seconds=0), 3).collect()
    assert sorted((r.page, r.id, r.error) for r in rows) == [(1, 10, None), (2, None, "ValueError: gone"), (3, 30, None)]
    rows = paged.read_pages(spark, paged.paged_source("paged_snap", "id int, name string", fetch, snapshot=lambda p: [(0, "old")], retries=1), 2).collect()
    assert sorted((r.page, r.name) for r in rows) == [(1, "p1"), (2, "old")]


def test_chart_bars(spark):
    chart = {"chart": {"result": [{"timestamp": [1704153600, 1704240000, 1704326400], "indicators": {"quote": [{"close": [1.0, 2.0, 3.0]}], "adjclose": [{"adjclose": [1.5, None, 3.5]}]}}]}}
    rows = spark.createDataFrame([("a", json.dumps(chart)), ("b", "{}")], "symbol string, payload string")
    assert sorted((r.symbol, str(r.d), r.close) for r in paged.chart_bars(rows).collect()) == [("a", "2024-01-02", 1.5), ("a", "2024-01-04", 3.5)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 3)], "k int, v string, n int")
    sinks.write_jsonl(df, f"{tmp_path}/j")
    assert files.read_jsonl(spark, f"{tmp_path}/j", "k int, v string, n int").orderBy("k").collect() == df.collect()
    sinks.write_by_entity(df, "k", f"{tmp_path}/e")
    assert spark.read.json(f"{tmp_path}/e").count() == 2
    sinks.append_log(df, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 4
    line = json.loads(sinks.request_lines(df, "k", F.concat(F.lit("say "), F.col("n").cast("string")), "messages").first().value)
    assert line["custom_id"] == "1" and line["params"]["messages"][0]["content"] == "say 5"
    assert sinks.report(df, "H", ["k", "v"], [F.desc("n")], 1).first().value == "# H\n\n| k | v |\n|---|---|\n| 1 | a |\n"
    text = df.select(sinks.markdown(F.lit("T"), {"v": F.col("v"), "n": F.col("n")}, F.lit("body")).alias("m")).orderBy("m").collect()
    assert {r.m for r in text} == {"---\nv: a\nn: 5\n---\n\n# T\n\nbody\n", "---\nn: 3\n---\n\n# T\n\nbody\n"}


def test_streams(spark, small, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y")], "k string, o int, s string").write.mode("append").parquet(f"{tmp_path}/in")
    held = {}

    def store(df, epoch):
        held["rows"] = [tuple(r) for r in df.collect()]

    def load():
        return spark.createDataFrame(held["rows"], "k string, o int, s string") if "rows" in held else None

    def run():
        status.upsert_stream(spark.readStream.schema("k string, o int, s string").parquet(f"{tmp_path}/in"), load, store, "k", "o", f"{tmp_path}/cp").awaitTermination(120)
        return sorted(held["rows"])

    assert run() == [("a", 3, "z"), ("b", 2, "y")]
    spark.createDataFrame([("b", 9, "new"), ("a", 2, "late")], "k string, o int, s string").write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == [("a", 3, "z"), ("b", 9, "new")]
