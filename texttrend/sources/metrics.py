"""Counts taken in the pass that writes, instead of scans of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import parsed_time
from .articles import CORRUPT_LINE, STATUS_OK, flatten_pages


def unreadable_time(df: DataFrame, time_col: str = "published_at"):
    """Condition for a time that is neither blank nor readable."""
    blank = F.coalesce(F.trim(F.col(time_col).cast("string")), F.lit("")) == ""
    return parsed_time(df, time_col).isNull() & ~blank


def observed_pages(pages: DataFrame, seen: Observation) -> DataFrame:
    """``pages``, counting all, rejected and corrupt ones and the hits that first pages report as they pass."""
    ok = F.coalesce(F.col("status") == STATUS_OK, F.lit(False))
    hits = F.when(ok & (F.col("page") == 0), F.coalesce(F.col("response.meta.hits"), F.lit(0)))
    corrupt = F.col(CORRUPT_LINE).isNotNull() if CORRUPT_LINE in pages.columns else F.lit(False)
    return pages.observe(
        seen,
        F.count(F.lit(1)).alias("pages"),
        F.count_if(~ok).alias("rejected"),
        F.count_if(corrupt).alias("corrupt"),
        F.coalesce(F.sum(hits), F.lit(0)).alias("hits"),
    )


def observed_articles(articles: DataFrame, seen: Observation, time_col: str = "published_at") -> DataFrame:
    """``articles``, counting them and those whose time cannot be read as they pass."""
    bad = unreadable_time(articles, time_col)
    return articles.observe(seen, F.count(F.lit(1)).alias("articles"), F.count_if(bad).alias("time_rejects"))


def write_collected(pages: DataFrame, path: str, keep: tuple[str, ...] = (), **flatten_options) -> dict[str, int]:
    """Flatten and write accepted pages; returns what was counted on the way.

    One scan gives the articles and the numbers of pages, rejected and corrupt
    pages, reported hits, articles and unreadable times. Nothing is shuffled, and
    Spark adds up the counts of tasks that succeed, so a task that is run again
    counts once.
    """
    page_counts, article_counts = Observation(), Observation()
    articles = flatten_pages(observed_pages(pages, page_counts), keep=keep, **flatten_options)
    observed_articles(articles, article_counts).write.mode("error").parquet(path)
    return {k: int(v or 0) for k, v in {**page_counts.get, **article_counts.get}.items()}
