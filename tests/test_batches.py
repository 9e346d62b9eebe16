"""Request files below a limit, in order."""

import os
import random

import pytest

from glossmark.sources import sinks


def test_files_stay_below_the_limit_and_keep_the_order(spark, tmp_path):
    draw = random.Random(1)
    lines = [(i, "é" * draw.randint(0, 40) + str(i)) for i in range(700)]
    df = spark.createDataFrame(lines, "i long, value string").repartition(5)
    sinks.write_batches(sinks.request_batches(df, "i", 1000), "i", f"file://{tmp_path}/out")
    folders = sorted((f for f in os.listdir(f"{tmp_path}/out") if f.startswith("batch=")), key=lambda f: int(f[6:]))
    read = []
    for f in folders:
        files = [x for x in os.listdir(f"{tmp_path}/out/{f}") if x.startswith("part-")]
        assert len(files) == 1
        text = open(f"{tmp_path}/out/{f}/{files[0]}", encoding="utf-8").read()
        assert len(text.encode()) <= 1000
        read += text.splitlines()
    assert read == [t for _, t in lines]
    with pytest.raises(ValueError, match="a file may have 20"):
        sinks.request_batches(df, "i", 20)


def test_no_lines(spark):
    assert sinks.request_batches(spark.createDataFrame([], "i long, value string"), "i", 10).collect() == []
