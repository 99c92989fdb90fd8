"""The whole job: collect, build the corpus, score, summarise, rank, trend."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import MONTH_COL, month_number, parsed_time
from ..operators.corpus import build_corpus, with_doc_id
from ..operators.evaluation import compare_rankers, judge
from ..operators.index import fit_index
from ..operators.retrieval import oldest_first, search_articles
from ..operators.search import TOP_K, rank_all
from ..operators.sentiment import annotate
from ..operators.trends import TREND_END, TREND_START, sentiment_distribution, sentiment_trend, split_unparsed
from ..schemas import ARTICLE_COLUMNS
from ..session import small_table, store
from ..sources.sinks import assert_not_empty, write_run

MONTH_FILES = 16  # files of a month's scored articles, at most
# The searches of the default job.
DEFAULT_QUERIES = ("artificial intelligence", "deepfake", "fake news", "misinformation")


@dataclass(frozen=True)
class Analysis:
    articles_path: str
    corpus_path: str
    corpus: DataFrame
    distribution: DataFrame
    ranking: DataFrame
    trend: DataFrame
    time_rejects: DataFrame  # articles whose time cannot be read, and so are in no trend


def collect_articles(
    archive: DataFrame,
    queries: Sequence[str] = DEFAULT_QUERIES,
    start: str = TREND_START,
    end: str = TREND_END,
    page_size: int | None = 10,
    max_pages: int | None = None,
    monthly: bool = True,
) -> DataFrame:
    """The oldest articles of an archive for every query and month, one row per find."""
    corpus = build_corpus(with_doc_id(archive) if "doc_id" not in archive.columns else archive)
    found = oldest_first(search_articles(corpus, queries, start, end, monthly), page_size, max_pages)
    return found.select(*ARTICLE_COLUMNS)


def write_scored(scored: DataFrame, out: str, run_date: str) -> str:
    """Write a numbered run of scored articles, partitioned by the month of their time."""
    seen = Observation()
    by_month = scored.withColumn(MONTH_COL, month_number(parsed_time(scored, "published_at"))).observe(seen, F.count(F.lit(1)).alias("n"))
    # Rows of a month meet in a few tasks, so that a month is a few files; the salt keeps one month from being one task.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(MONTH_FILES))
    path = write_run(by_month.repartition(MONTH_COL, salt), out, "corpus_with_sentiment", run_date, (MONTH_COL,))
    if not seen.get["n"]:  # counted while writing: looking first would score the articles twice
        raise ValueError("no articles collected")
    return path


def run_analysis(
    articles: DataFrame,
    out: str,
    run_date: str,
    lexicon: DataFrame | None = None,
    method: str = "lexicon",
    predictor_factory: Callable | None = None,
    queries: Sequence[str] = DEFAULT_QUERIES,
    k: int = TOP_K,
    text: str = "text",
) -> Analysis:
    """Write the numbered raw and scored tables, and return the reports over the stored ones.

    ``text`` names the column that is scored, by either method; searches read
    the whole text. Searches run at once and their results are kept; the reports are lazy.
    """
    spark = articles.sparkSession
    articles_path = write_run(assert_not_empty(articles), out, "articles", run_date)
    corpus = build_corpus(with_doc_id(spark.read.parquet(articles_path)))
    scored = annotate(corpus, method, lexicon, predictor_factory, text)
    corpus_path = write_scored(scored, out, run_date)
    stored = spark.read.parquet(corpus_path)
    index = fit_index(stored)
    asked = small_table(spark, list(enumerate(queries)), "query_id long, query string")
    return Analysis(
        articles_path,
        corpus_path,
        stored,
        sentiment_distribution(stored),
        compare_rankers(judge(store(rank_all(index, queries, k)), stored, asked), k, asked),
        sentiment_trend(stored),
        split_unparsed(stored)[1],
    )
