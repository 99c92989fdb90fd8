"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from texttrend.operators import index as ix
from texttrend.operators import retrieval, search, sentiment, trends
from texttrend.plans import analysis, views
from texttrend.plans.catalog import QUERIES


def plan(df):
    # Scans cut their filters off at this length in a printed plan.
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_python_for_the_model_only(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("ArrowEvalPython" in text) == (name == "model_polarity")


def test_documents_are_scored_where_they_are_read(spark, folder):
    docs = views.table(spark, folder, "documents")
    text = plan(sentiment.lexicon_scores(docs, views.lexicon(spark)))
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text
    # one shuffle of documents, and the lexicon's own
    assert text.count("Exchange hashpartitioning(doc_id") == 1


def test_postings_are_never_the_broadcast_side(spark, folder):
    index = ix.fit_index(views.table(spark, folder, "documents"))
    for run in search.RANKERS.values():
        for line in plan(run(index, ["license", "best no"])).splitlines():
            assert not ("BroadcastHashJoin" in line and "BuildLeft" in line and "_run" in line)
    merged = ix.join_terms(ix.term_counts(index.docs), ix.smoothed_idf(index).select("term", "idf"), small=False)
    assert "SortMergeJoin" in plan(merged)


def test_top_k_is_trimmed_before_the_shuffle(spark, folder):
    index = ix.fit_index(views.table(spark, folder, "documents"))
    assert "WindowGroupLimit" in plan(search.bm25_search(index, ["license"]))
    articles = views.articles(views.table(spark, folder, "documents"))
    assert "WindowGroupLimit" in plan(retrieval.dedup_articles(articles))


@pytest.mark.parametrize("name", ["tfidf", "bm25"])
def test_searches_read_their_words_and_shuffle_only_the_best(spark, folder, name):
    index = ix.fit_index(views.table(spark, folder, "documents"))
    text = plan(search.RANKERS[name](index, ["license", "best no"], fill_zero=False))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "texttrend_postings" in line)
    assert "Bucketed: true" in scan and "PartitionFilters: [part#" in scan and "Exchange hashpartitioning(query_id" in text
    assert ", doc_id" not in "".join(re.findall(r"Exchange hashpartitioning\(([^)]*)", text))
    assert "tokens" not in text


def test_zero_filling_never_lists_all_documents_for_each_query(spark):
    rows = [(i, "a b") for i in range(9)] + [(9, "c")]
    index = ix.fit_index(spark.createDataFrame(rows, "doc_id long, text string"))
    assert index.mean_idf < 0
    text = plan(search.bm25_search(index, ["a", "c"]))
    for line in text.splitlines():
        assert not ("Generate explode" in line and "doc_id" in line)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_retrieval_does_not_shuffle_and_filters_at_the_scan(spark, folder):
    events = views.table(spark, folder, "events")
    found = retrieval.search_articles(
        events.select(F.col("event_id").alias("doc_id"), F.col("props").alias("text"), F.col("ts").alias("published_at")),
        ["k"], "2024-01-02", "2024-01-20")
    assert "Exchange" not in plan(found)
    orders = views.table(spark, folder, "orders")
    text = plan(trends.time_filter(orders, "o_orderdate", "1996-01-01", "1996-12-31"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    trend = plan(trends.sentiment_trend(orders, "o_orderdate", "o_totalprice", start="1996-01-01", end="1996-12-31"))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in trend


def test_tables_by_month_are_pruned(spark, folder, tmp_path):
    articles = views.articles(views.table(spark, folder, "documents")).withColumn("sentiment", F.lit(0.5))
    odd = articles.limit(3).withColumn("published_at", F.lit("soon"))
    path = analysis.write_scored(articles.unionByName(odd), str(tmp_path), "2024-12-31")
    stored = spark.read.parquet(path)
    assert stored.count() == articles.count() + 3
    ranged = trends.time_filter(stored, start="2024-03-05", end="2024-05-06")
    assert ranged.count() == trends.time_filter(articles, start="2024-03-05", end="2024-05-06").count() > 0
    searched = retrieval.search_articles(stored, ["the"], "2024-03-05", "2024-05-06", text="content")
    assert searched.count() == retrieval.search_articles(articles, ["the"], "2024-03-05", "2024-05-06", text="content").count() > 0
    for df in (ranged, searched, trends.sentiment_trend(stored, start="2024-03-05", end="2024-05-06")):
        scan = next(line for line in plan(df).splitlines() if "FileScan" in line)
        assert "(published_month#" in scan.split("PartitionFilters")[1] and "202403" in scan and "202405" in scan


def test_several_searches_take_one_scan(spark, folder):
    assert plan(QUERIES["tag_union"](spark, folder)).count("FileScan") == 1
