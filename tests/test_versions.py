"""A table that is replaced: readers see one version whole."""

import os
import threading

import pytest

from glossmark.sources.versions import VersionedTable


def test_readers_see_the_old_table_until_the_new_one_is_there(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.version() is None
    assert table.replace(spark.range(10)) == 1
    old = table.read()
    seen = []
    written = threading.Event()

    def slow(rows):
        written.wait(60)
        yield from rows

    def write():
        table.replace(spark.range(25).repartition(2))
        written.set()

    # a version whose writer hasn't named it yet is none
    open(f"{tmp_path}/t/_versions/000000000002", "w").close()
    seen.append(table.read().count())
    os.remove(f"{tmp_path}/t/_versions/000000000002")
    writer = threading.Thread(target=write)
    writer.start()
    while not written.is_set():
        seen.append(table.read().count())
    writer.join()
    assert set(seen) <= {10, 25} and seen[0] == 10
    assert table.read().count() == 25 and old.count() == 10


def test_a_version_can_be_made_of_the_one_before_and_old_ones_go(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", keep=2)
    table.replace(spark.range(3))
    for _ in range(3):
        now = table.read()
        table.replace(now.unionByName(now))
    assert table.version() == 4 and table.read().count() == 24 and table.read(3).count() == 12
    folders = [f for f in os.listdir(f"{tmp_path}/t") if f.startswith("data-")]
    assert len(folders) == 2
    with pytest.raises(ValueError, match="2 at least"):
        VersionedTable(spark, str(tmp_path), keep=1)


def test_two_writers_take_two_numbers(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", keep=5)
    got = []
    threads = [threading.Thread(target=lambda n=n: got.append((table.replace(spark.range(n)), n))) for n in (5, 6, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v for v, _ in got) == [1, 2, 3]
    assert all(table.read(v).count() == n for v, n in got)
