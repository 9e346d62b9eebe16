"""Line numbers over files of many splits."""

import json
import random

import pytest

from glossmark.sources import lines


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(tmp_path, bad):
    draw, files = random.Random(3), {}
    for name, n in (("a.jsonl", 400), ("b.jsonl", 3), ("c.jsonl", 900), ("d.jsonl", 0)):
        rows = [json.dumps({"i": i, "t": "x" * draw.randint(0, 60)}) if draw.random() > 0.05 else draw.choice(["", "  "]) for i in range(n)]
        for i, text in bad.get(name, {}).items():
            rows[i] = text
        (tmp_path / name).write_text("".join(r + "\n" for r in rows))
        files[name] = rows
    return files


def test_numbers_are_those_of_the_file(spark, tmp_path, small_splits):
    files = written(tmp_path, {})
    found = lines.numbered_lines(spark, f"file://{tmp_path}")
    assert found.rdd.getNumPartitions() > 20
    got = sorted((r.file.rpartition("/")[2], r.line_no, r.line) for r in found.collect())
    assert got == sorted((name, i + 1, r) for name, rows in files.items() for i, r in enumerate(rows))


def test_the_first_bad_line_of_each_file(spark, tmp_path, small_splits):
    bad = {"a.jsonl": {377: "{broken", 390: "[1]"}, "c.jsonl": {850: '"text"', 5: "7"}}
    written(tmp_path, bad)
    got = {(r.file.rpartition("/")[2], r.line_no, r.line) for r in lines.first_bad(spark, f"file://{tmp_path}").collect()}
    assert got == {("a.jsonl", 378, "{broken"), ("c.jsonl", 6, "7")}
    assert {(r.file.rpartition("/")[2], r.line_no) for r in lines.bad_lines(spark, f"file://{tmp_path}").collect()} == {(n, i + 1) for n, b in bad.items() for i in b}
    with pytest.raises(lines.BadLine, match=r"a\.jsonl, line 378"):
        lines.read_strict(spark, f"file://{tmp_path}", "i int, t string")


def test_a_good_folder_is_read(spark, tmp_path, small_splits):
    files = written(tmp_path, {})
    rows = lines.read_strict(spark, f"file://{tmp_path}", "i int, t string").where("i is not null")
    assert rows.count() == sum(r.strip() != "" for own in files.values() for r in own)
