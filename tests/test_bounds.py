import random
import re

import pytest
from pyspark.sql import functions as F

from texttrend.operators import bounds, index, search

QUERIES = ["the the orre", "orre", "the", "zebra orre the", "absent", ""]


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        text = ["the"] * draw.randint(1, 4) + draw.choices(words, k=draw.randint(5, 30))
        text += ["orre"] * (draw.random() < 0.04) * draw.randint(1, 5) + ["zebra"] * (i in (3, 700))
        draw.shuffle(text)
        rows.append((i, " ".join(text)))
    rows.append((1500, None))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def fitted(corpus):
    stored = index.fit_index(corpus, max_df=1.0)
    return stored, bounds.fit_bounds(stored, zone_docs=16, block=4)


def rows(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 8)) for r in df.collect())


@pytest.mark.parametrize("ranker", ["bm25", "tfidf"])
@pytest.mark.parametrize("fill_zero", [True, False])
@pytest.mark.parametrize("k", [1, 10, 1400])
def test_same_rows_as_the_full_search(fitted, ranker, fill_zero, k):
    stored, bound = fitted
    want = search.RANKERS[ranker](stored, QUERIES, k, fill_zero)
    assert rows(bounds.bounded_search(bound, QUERIES, ranker, k, fill_zero).results) == rows(want)


@pytest.mark.parametrize("k1, b", [(0.5, 0.0), (3.0, 1.0), (0.0, 0.3)])
def test_bounds_hold_for_other_settings(fitted, k1, b):
    stored, bound = fitted
    want = search.bm25_search(stored, QUERIES, k1=k1, b=b)
    assert rows(bounds.bounded_search(bound, QUERIES, k1=k1, b=b).results) == rows(want)


def read_share(found, query_id):
    total = lambda df: df.filter(F.col("query_id") == query_id).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return total(found.read), total(found.offered)


@pytest.mark.parametrize("ranker", ["bm25", "tfidf"])
def test_fewer_postings_are_read(fitted, ranker):
    _, bound = fitted
    found = bounds.bounded_search(bound, ["the the orre", "orre", "the"], ranker)
    for query_id in (0, 1, 2) if ranker == "bm25" else (0, 1):
        read, offered = read_share(found, query_id)
        assert 0 < read < 0.6 * offered, (query_id, read, offered)
    if ranker == "bm25":  # "the" is a stop word of the other ranker
        assert read_share(found, 0)[1] > 1500


def test_plan_skips_files_and_lists_postings_last(fitted):
    _, bound = fitted
    plan = bounds.bounded_search(bound, ["zebra"]).results._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "postings" in line and "FileScan" in line)
    assert re.search(r"PartitionFilters: \[[^]]*part#", scan) and re.search(r"PushedFilters: \[[^]]*In\(zone", scan)


def test_lists_stay_within_a_zone(fitted):
    _, bound = fitted
    most = bound.blocks.groupBy("term", "zone").agg(F.sum("n").alias("n"), F.max("n").alias("block"))
    assert most.agg(F.max("block")).first()[0] == 4
    assert most.filter("term = 'the'").count() == bound.zones


def test_negative_mean_idf_reads_everything(spark):
    docs = spark.createDataFrame([(i, "a b c" if i % 7 else "a b d") for i in range(40)], "doc_id long, text string")
    stored = index.fit_index(docs)
    assert stored.mean_idf < 0
    bound = bounds.fit_bounds(stored, zone_docs=4, block=2)
    found = bounds.bounded_search(bound, ["a", "d c"], k=5)
    assert rows(found.results) == rows(search.bm25_search(stored, ["a", "d c"], 5))
    assert read_share(found, 0)[0] == read_share(found, 0)[1]


def test_loaded_again(spark, corpus, tmp_path):
    stored = index.fit_index(corpus, f"file://{tmp_path}/index", max_df=1.0)
    bounds.fit_bounds(stored, f"file://{tmp_path}/bounds", zone_docs=64, block=8)
    bound = bounds.load_bounds(spark, f"file://{tmp_path}/index", f"file://{tmp_path}/bounds")
    assert rows(bounds.bounded_search(bound, QUERIES).results) == rows(search.bm25_search(stored, QUERIES))


def test_no_documents(spark):
    stored = index.fit_index(spark.createDataFrame([], "doc_id long, text string"))
    assert bounds.bounded_search(bounds.fit_bounds(stored), ["a"]).results.count() == 0
