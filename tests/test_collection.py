import json

import pytest

from texttrend.operators import trends
from texttrend.sources import articles as sources
from texttrend.sources import metrics
from texttrend.sources.collection import Collection


def page(query, month, number=0, status="OK", docs=2, hits=7, time="2024-01-02T00:00:00Z"):
    listed = [{"headline": {"main": f"{query} {month} {number} {i}"}, "web_url": f"http://x/{query}/{month}/{number}/{i}", "pub_date": time} for i in range(docs)]
    return json.dumps({"query": query, "range_start": month, "page": number, "status": status, "response": {"docs": listed, "meta": {"hits": hits}}})


@pytest.fixture
def land(spark, tmp_path):
    def write(name, lines):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "pages.json").write_text("\n".join(lines) + "\n")
        return sources.read_pages(spark, f"file://{folder}")

    return write


GRID = [("a", "2024-01"), ("a", "2024-02"), ("b", "2024-01"), ("b", "2024-02"), ("a", "2024-01")]


@pytest.fixture
def grid(spark):
    return spark.createDataFrame(GRID, "query string, range_start string")


def fetch_from(pages):
    keyed = pages
    return lambda searches: keyed


def state(collected):
    return sorted((r.query, r.range_start, r.attempt, r.status) for r in collected.ledger().collect())


def test_failed_searches_run_again_alone(spark, tmp_path, grid, land):
    collected = Collection(spark, f"file://{tmp_path}/out")
    cut = page("b", "2024-01", 1)[:70]  # a line broken off behind its search
    first = land("first", [page("a", "2024-01"), page("a", "2024-01", 1), page("a", "2024-02", status="ERROR"), page("b", "2024-01"), cut])
    assert collected.articles() is None
    assert collected.run(grid, fetch_from(first)) == 1
    assert state(collected) == [("a", "2024-01", 1, "finished"), ("a", "2024-02", 1, "failed"), ("b", "2024-01", 1, "failed"), ("b", "2024-02", 1, "unanswered")]
    assert collected.articles().count() == 4
    assert sorted((r.status or "", (r.corrupt_line or "")[:9]) for r in collected.rejects().collect()) == [("", cut[:9]), ("ERROR", "")]

    asked = []
    second = land("second", [page("a", "2024-02"), page("b", "2024-01"), page("b", "2024-01", 1), page("b", "2024-02", docs=0)])

    def fetch(searches):
        asked.extend(sorted(map(tuple, searches.collect())))
        return second

    assert collected.run(grid, fetch) == 2
    assert asked == [("a", "2024-02"), ("b", "2024-01"), ("b", "2024-02")]
    assert collected.pending(grid).count() == 0
    urls = [r.url for r in collected.articles().collect()]
    assert len(urls) == len(set(urls)) == 4 + 2 + 4


def test_an_attempt_that_was_lost_counts_nowhere(spark, tmp_path, grid, land):
    collected = Collection(spark, f"file://{tmp_path}/out")
    pages = land("pages", [page(q, m) for q, m in GRID[:4]])

    def lost(searches):
        raise OSError("no answer")

    with pytest.raises(OSError):
        collected.run(grid, lost)
    assert collected.ledger().count() == 0 and collected.pending(grid).count() == 4
    collected.run(grid, fetch_from(pages))
    assert collected.articles().count() == 8


def test_no_more_searches_than_the_quota_leaves(spark, tmp_path, grid, land):
    collected = Collection(spark, f"file://{tmp_path}/out")
    pages = land("pages", [page(q, m) for q, m in GRID[:4]])
    fetch = lambda searches: pages.join(searches, ["query", "range_start"], "left_semi").select(pages.columns)
    collected.run(grid, fetch, limit=3)
    assert collected.pending(grid).count() == 1 and collected.articles().count() == 6
    collected.run(grid, fetch, limit=3)
    assert collected.articles().count() == 8


def test_counts_come_from_the_pass_that_writes(spark, tmp_path, land):
    pages = land("pages", [page("a", "2024-01"), page("a", "2024-01", 1, hits=9), page("b", "2024-01", status="ERROR"), page("c", "x", time="2024-13-01"), "{broken"])
    seen = metrics.write_collected(pages, f"file://{tmp_path}/out")
    stored = spark.read.parquet(f"file://{tmp_path}/out")
    assert seen == {"pages": 5, "rejected": 2, "corrupt": 1, "hits": 14, "articles": 6, "time_rejects": 2}
    assert stored.count() == seen["articles"]
    assert sources.split_pages(pages)[1].cache().count() == seen["rejected"]
    assert trends.split_unparsed(stored)[1].count() == seen["time_rejects"]
