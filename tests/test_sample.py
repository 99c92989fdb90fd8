"""Known results over a sample of 40 scored articles.

Set TEXTTREND_SAMPLE to a CSV with the article columns, text and sentiment.
"""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from texttrend.operators import evaluation, search, trends
from texttrend.operators import index as ix
from texttrend.operators.corpus import build_corpus
from texttrend.schemas import SCORED_ARTICLE
from texttrend.sources.articles import read_articles

PATH = os.environ.get("TEXTTREND_SAMPLE")
pytestmark = pytest.mark.skipif(not PATH, reason="TEXTTREND_SAMPLE is not set")


@pytest.fixture(scope="module")
def sample(spark):
    # Row order is only meaningful in this one small file.
    rows = read_articles(spark, PATH, SCORED_ARTICLE).coalesce(1).withColumn("_o", F.monotonically_increasing_id())
    numbered = rows.withColumn("doc_id", (F.row_number().over(Window.orderBy("_o")) - 1).cast("long")).drop("_o")
    return numbered.cache()


def test_corpus_text(sample):
    rebuilt = build_corpus(sample.withColumnRenamed("text", "want").drop("sentiment"))
    assert sample.count() == 40 and rebuilt.filter("text = want").count() == 40


def test_distribution_and_trend(sample):
    row = trends.sentiment_distribution(sample).first()
    assert tuple(row) == pytest.approx((0.1339494048, 0.1891914804, 0.5, 0.05, 0.45))
    months = {r.label: r.sentiment for r in trends.sentiment_trend(sample).collect()}
    assert months.pop("2024-12") == pytest.approx(0.1339494048) and set(months.values()) == {None} and len(months) == 11


def test_search_and_metrics(spark, sample):
    index = ix.fit_index(sample)
    assert (index.n_tokens, index.average_length, index.n_terms) == (1978, 49.45, 630)
    assert index.mean_idf == pytest.approx(3.0604550685)
    assert ix.vocabulary(index).count() == 80
    got = {}
    for name, run in search.RANKERS.items():
        for r in run(index, ["trump musk", "new york law", "the year of the trump"], k=5).collect():
            got[name, r.query_id, r["rank"]] = (r.doc_id, round(r.score, 6))
    assert got["tfidf", 0, 1] == (16, 0.377082) and got["tfidf", 1, 5] == (5, 0.256892) and got["tfidf", 2, 3] == (2, 0.454875)
    assert got["bm25", 0, 5] == (2, 1.782165) and got["bm25", 1, 4] == (22, 4.14579) and got["bm25", 2, 1] == (2, 5.600523)
    queries = ["artificial intelligence", "deepfake", "fake news", "misinformation"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    report = evaluation.compare_rankers(evaluation.judge(search.rank_all(index, queries), sample, asked))
    mean = {r.ranker: (r.precision_at_k, r.ndcg, r.mrr) for r in report.filter("query IS NULL").collect()}
    assert mean == {"tfidf": (0.25, 0.25, 0.25), "bm25": (pytest.approx(0.275), 0.5, 0.5)}
