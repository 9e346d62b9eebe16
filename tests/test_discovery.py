"""Paged sources that find out their own end, and the frontier loop, against plain loops."""

import os
import random

import pytest

from glossmark.checkpoints import settled
from glossmark.sources import discovery

PER_PAGE = 4


def site(folder, pages, tells=True, fails=()):
    """fetch over so many pages; which page was asked for is noted in folder, as executors are other processes; fails: (page, times)."""

    def fetch(page):
        asked = len([f for f in os.listdir(folder) if f.startswith(f"p{page}-")])
        with open(f"{folder}/p{page}-{asked}-{os.getpid()}", "w"):
            pass
        if asked < dict(fails).get(page, 0):
            raise OSError(f"page {page} is down")
        rows = [(f"u{(page - 1) * PER_PAGE + i - (i == 0 and page > 1)}", f"page {page}") for i in range(PER_PAGE)] if page <= pages() else []
        return rows, pages() if tells else None

    return fetch


def plain(pages):
    first = {}
    for page in range(1, pages + 1):
        for i in range(PER_PAGE):
            first.setdefault(f"u{(page - 1) * PER_PAGE + i - (i == 0 and page > 1)}", page)
    return first


def test_a_batch_reads_what_page_one_says_each_url_once(spark, tmp_path):
    source = discovery.discovered_source("found_batch", "url string, title string", site(str(tmp_path), lambda: 7, fails=[(1, 1), (3, 2)]), wait_seconds=0)
    items, failed = discovery.crawl_list(spark, source)
    assert {r.url: r.page for r in items.collect()} == plain(7)
    assert failed.collect() == []


def test_limit_and_pages_that_stay_down(spark, tmp_path):
    source = discovery.discovered_source("found_down", "url string, title string", site(str(tmp_path), lambda: 50, fails=[(2, 99)]), wait_seconds=0)
    items, failed = discovery.crawl_list(spark, source, limit=3)
    assert {r.page for r in items.collect()} == {1, 3}
    assert [(r.page, r.error) for r in failed.collect()] == [(2, "OSError: page 2 is down")]
    assert not any(f.startswith("p4-") for f in os.listdir(tmp_path))


def test_nothing_is_known_without_page_one(spark, tmp_path):
    source = discovery.discovered_source("found_none", "url string, title string", site(str(tmp_path), lambda: 5, fails=[(1, 99)]), wait_seconds=0)
    with pytest.raises(Exception, match="page 1 is down"):
        discovery.crawl_list(spark, source)[0].collect()


def test_a_stream_ends_at_the_first_empty_page_and_goes_on_later(spark, tmp_path):
    count = tmp_path / "pages"
    count.write_text("3")
    (tmp_path / "asked").mkdir()
    source = discovery.discovered_source("found_stream", "url string, title string", site(str(tmp_path / "asked"), lambda: int(count.read_text()), tells=False), wait_seconds=0)
    spark.dataSource.register(source)

    def run():
        query = spark.readStream.format("found_stream").load().writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        assert query.awaitTermination(120)
        return sorted(r.page for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == sorted([1, 2, 3] * PER_PAGE)
    count.write_text("5")
    assert run() == sorted([1, 2, 3, 4, 5] * PER_PAGE)
    assert run() == sorted([1, 2, 3, 4, 5] * PER_PAGE)


@pytest.mark.parametrize("depth", [0, 2, 30])
def test_crawl_equals_a_plain_search(spark, depth):
    draw = random.Random(depth)
    links = [(draw.randrange(60), draw.choice([None, *range(60)])) for _ in range(80)] + [(i, i + 1) for i in range(100, 115)] + [(3, 100), (4, 4)]
    seeds = [3, 4, 4]
    want = dict.fromkeys(seeds, 0)
    edge = list(want)
    for step in range(1, depth + 1):
        edge = sorted({t for p, t in links if p in edge and t is not None and t not in want and t % 7})
        want |= dict.fromkeys(edge, step)
    found = discovery.crawl(spark.createDataFrame(links, "page long, to long"), spark.createDataFrame([(s,) for s in seeds], "page long"), settled, depth, lambda p: p % 7 != 0)
    rows = [tuple(r) for r in found.collect()]
    assert dict(rows) == want and len(rows) == len(want)
