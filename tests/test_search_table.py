import random

import pytest
from pyspark.sql import functions as F

from texttrend.operators import retrieval

ARTICLES = "doc_id long, text string, published_at string, title string"


@pytest.fixture(scope="module")
def articles(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(300):
        text = " ".join(draw.choices(words, k=draw.randint(0, 25)) + ["the"] * (i % 3 > 0))
        rows.append((i, text.title() if i % 5 else text, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}T10:00:00Z", "t"))
    rows += [(300, None, "2024-02-01T00:00:00Z", "t"), (301, "the w1 w2", None, "t"), (302, "the", "not a time", "t")]
    return spark.createDataFrame(rows, ARTICLES)


QUERIES = ["the", "w1 w2", "W3 the the", "absent w1", "", None, "w1 w2", "w5 w6 w7 w8"]


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, query string")


def expected(articles):
    listed = [q for q in QUERIES if q]
    found = retrieval.search_articles(articles, listed[:4] + listed[5:], "2024-01-15", "2024-11-20")
    rows = {(r["query"], str(r.range_start), str(r.range_end), r.doc_id) for r in found.collect()}
    return sorted((i, *r[1:]) for i, q in enumerate(QUERIES) for r in rows if r[0] == q)


@pytest.mark.parametrize("small", [True, False])
def test_same_rows_as_a_list_of_queries(articles, asked, small, monkeypatch):
    if not small:
        monkeypatch.setattr(retrieval, "is_small", lambda df: False)
    found = retrieval.search_table(articles, asked, "2024-01-15", "2024-11-20")
    assert found.columns == ["query_id", "range_start", "range_end", "doc_id", "text", "published_at", "title"]
    got = sorted((r.query_id, str(r.range_start), str(r.range_end), r.doc_id) for r in found.collect())
    assert got == expected(articles) and len(got) > 150


def test_queries_are_keyed_by_their_rarest_word(articles, asked):
    keyed = {r.query_id: r.key for r in retrieval.keyed_queries(articles, asked).collect()}
    assert set(keyed) == {0, 1, 2, 6, 7}
    assert keyed[0] == "the" and keyed[2] == "w3"


def test_whole_range(articles, asked):
    found = retrieval.search_table(articles, asked, "2024-01-15", "2024-11-20", monthly=False)
    assert {(str(r.range_start), str(r.range_end)) for r in found.collect()} == {("2024-01-15", "2024-11-20")}


def test_plan_does_not_grow_with_the_queries(spark, articles, asked):
    many = spark.range(500).select(F.col("id").alias("query_id"), F.concat(F.lit("w"), (F.col("id") % 40).cast("string"), F.lit(" the")).alias("query"))
    plans = [retrieval.search_table(articles, q, "2024-01-01", "2024-12-31")._jdf.queryExecution().executedPlan().toString() for q in (asked, many)]
    assert abs(plans[0].count("\n") - plans[1].count("\n")) <= 2
    assert "Cartesian" not in plans[1] and "NestedLoop" not in plans[1]


def test_empty_tables(articles, asked):
    assert retrieval.search_table(articles.limit(0), asked, "2024-01-01", "2024-12-31").count() == 0
    assert retrieval.search_table(articles, asked.limit(0), "2024-01-01", "2024-12-31").count() == 0
