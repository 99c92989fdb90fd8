import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from texttrend.functions.dates import month_ranges
from texttrend.operators import retrieval as r
from texttrend.operators.topn import SLICES, WINDOW_LIMIT, top_n


@pytest.mark.parametrize(
    "start, end, want",
    [
        ("2024-01-15", "2024-03-10", [("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-10")]),
        ("2024-03-01", "2024-02-01", []),
        ("2023-12-31", "2024-01-01", [("2023-12-31", "2023-12-31"), ("2024-01-01", "2024-01-01")]),
        ("2024-05-20", "2024-05-20", [("2024-05-20", "2024-05-20")]),
    ],
)
def test_month_ranges(spark, start, end, want):
    got = spark.range(1).select(month_ranges(start, end)).first()[0]
    assert [(str(a), str(b)) for a, b in got] == want


def test_page_cap():
    assert r.page_cap() == 30
    assert r.page_cap(10) == 10
    assert r.page_cap(10, 1) == 10
    assert r.page_cap(50, 3) == 30
    assert r.page_cap(2000, 500) == 1000
    assert r.page_cap(25, 20) == 25


def test_search_grid(frame):
    grid = r.search_grid(frame([("a",), ("b",)], "query string"), "2024-01-15", "2024-02-10")
    rows = {(x.query, x.begin_date, x.end_date, x.month) for x in grid.collect()}
    assert rows == {(q, *rest) for q in "ab" for rest in (("20240115", "20240131", "2024-01"), ("20240201", "20240210", "2024-02"))}
    assert r.search_grid(frame([("a",)], "query string"), "2024-01-15", "2024-03-10", monthly=False).count() == 1


def test_search_and_oldest_first(frame):
    rows = [
        (1, "fake news here", "2024-01-31T23:59:59Z"),
        (2, "news, FAKE", "2024-02-01T00:00:00Z"),
        (3, "fakenews", "2024-02-02T00:00:00Z"),
        (4, "fake news", "2024-02-29T12:00:00Z"),
        (5, "fake news", "2024-03-01T00:00:00Z"),
        (6, "fake news", ""),
    ]
    df = frame(rows, "doc_id long, text string, published_at string")
    found = r.search_articles(df, ["fake news", "deepfake"], "2024-01-15", "2024-02-29")
    assert {(x.doc_id, str(x.range_start), str(x.range_end)) for x in found.collect()} == {
        (1, "2024-01-15", "2024-01-31"),
        (2, "2024-02-01", "2024-02-29"),
        (4, "2024-02-01", "2024-02-29"),
    }
    first = r.oldest_first(found, page_size=1)
    assert {x.doc_id for x in first.collect()} == {1, 2}
    whole = r.oldest_first(r.search_articles(df, ["fake news"], "2024-01-15", "2024-02-29", monthly=False), page_size=2)
    assert [(x.position, x.doc_id) for x in whole.orderBy("position").collect()] == [(1, 1), (2, 2)]


def test_dedup_keeps_earliest_and_rows_without_url(frame):
    rows = [(1, "u", "2024-02-01T00:00:00Z"), (2, "u", "2024-01-01T00:00:00Z"), (3, "u", ""), (4, None, ""), (5, None, "")]
    df = frame(rows, "doc_id long, url string, published_at string")
    assert {x.doc_id for x in r.dedup_articles(df).collect()} == {2, 4, 5}


def test_quota(spark):
    day = dt.datetime(2024, 1, 1)
    log = spark.range(5001).select(F.col("id").alias("request_id"), F.lit(day).alias("ts"))
    log = log.unionByName(spark.range(1).select((F.col("id") + 9000).alias("request_id"), F.lit(day + dt.timedelta(1)).alias("ts")))
    left = {str(x.day): (x.requests, x.remaining) for x in r.daily_quota(log).collect()}
    assert left == {"2024-01-01": (5001, 0), "2024-01-02": (1, 4999)}
    admitted = r.admit_requests(log)
    assert admitted.groupBy("day").count().orderBy("day").toPandas()["count"].tolist() == [5000, 1]
    assert admitted.agg(F.max("request_id")).first()[0] == 9000 and admitted.filter("request_id = 5000").isEmpty()
    assert r.cut_queries(["a", "b"], 1) == ["a"]


def test_top_n_in_slices_equals_plain_ranking(spark):
    df = spark.range(20000).select(F.lit(1).alias("g"), F.xxhash64("id").alias("v"), "id")
    want = [x.id for x in df.orderBy("v", "id").limit(700).collect()]
    before = spark.conf.get(WINDOW_LIMIT)
    try:
        for limit in ("10000", "10"):
            spark.conf.set(WINDOW_LIMIT, limit)
            got = top_n(df, ["g"], [F.col("v"), F.col("id")], 700, slice_by=["id"])
            assert [x.id for x in got.orderBy("rank").collect()] == want
        assert SLICES[0] > SLICES[1] > 1
        with pytest.raises(ValueError):
            top_n(df, ["g"], [F.col("v")], 700)
    finally:
        spark.conf.set(WINDOW_LIMIT, before)


def test_blank_urls_are_no_key(frame):
    rows = [(1, "", "2024-01-01"), (2, "", "2024-01-02"), (3, " ", "2024-01-03"), (4, None, "2024-01-04"), (5, "u", "2024-01-06"), (6, "u", "2024-01-05")]
    df = frame(rows, "doc_id long, url string, published_at string")
    assert sorted(x.doc_id for x in r.dedup_articles(df).collect()) == [1, 2, 3, 4, 6]


def test_queries_without_words_and_repeated_queries(frame):
    df = frame([(1, "fake news today", "2024-01-20T00:00:00Z")], "doc_id long, text string, published_at string")
    found = r.search_articles(df, ["!!", "news", "news", ""], "2024-01-01", "2024-01-31")
    assert [x.query for x in found.collect()] == ["news", "news"]


def test_quota_is_the_same_with_slices_in_slices(frame, spark):
    df = spark.range(5000).selectExpr("id", "pmod(xxhash64(id), 100) AS v", "id % 2 AS g")
    got = top_n(df, ["g"], [F.col("v").asc(), F.col("id").asc()], 1200, slice_by=["id"])
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("v", "id"))).filter("rank <= 1200")
    assert sorted(map(tuple, got.select("id", "rank").collect())) == sorted(map(tuple, plain.select("id", "rank").collect()))
