"""Search planning, date-range retrieval, deduplication and request quota."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compact_date, month_label, month_ranges, parsed_time, within_months
from ..functions.text import tokenize
from ..session import is_small, store
from .topn import top_n

# Page and quota limits of the search service.
PAGE_ROWS = 10
DEFAULT_MAX_PAGES = 3
HARD_MAX_PAGES = 100
DAILY_LIMIT = 5000


def is_blank(key: str) -> Column:
    return F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == ""


def page_cap(page_size: int | None = None, max_pages: int | None = None) -> int:
    """Most rows one search returns: the page size, bounded by the pages read."""
    pages = DEFAULT_MAX_PAGES if max_pages is None else max_pages
    size = pages * PAGE_ROWS if page_size is None else page_size
    read = min(size // PAGE_ROWS + 1, pages, HARD_MAX_PAGES)
    return max(0, min(size, PAGE_ROWS * read))


def search_grid(queries: DataFrame, start: str, end: str, monthly: bool = True) -> DataFrame:
    """One row per search: each query with each month of the range (or all of it)."""
    if monthly:
        ranges = month_ranges(start, end)
    else:
        whole = F.struct(F.lit(start).cast("date").alias("range_start"), F.lit(end).cast("date").alias("range_end"))
        ranges = F.array(whole)
    grid = queries.select("query", F.explode(ranges).alias("r")).select("query", "r.range_start", "r.range_end")
    return grid.select(
        "query",
        "range_start",
        "range_end",
        compact_date("range_start").alias("begin_date"),
        compact_date("range_end").alias("end_date"),
        month_label("range_start").alias("month"),
    )


def search_articles(
    articles: DataFrame,
    queries: Sequence[str],
    start: str,
    end: str,
    monthly: bool = True,
    text: Column | str = "text",
    time_col: str = "published_at",
) -> DataFrame:
    """Articles matching each query within each date range, days inclusive.

    A query matches when all its words occur in the text, one without words
    never; a query listed twice is searched twice. Both conditions are
    decided inside the article's own row: the month follows from the date, and
    the query list is part of the plan. Nothing is joined or shuffled. The
    date range is filtered at the scan when ``time_col`` is a timestamp, and
    prunes the partitions of tables written by month.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    ts = parsed_time(articles, time_col)
    # Compared as instants, which Parquet can filter on; a date cast it cannot.
    in_range = (ts >= lo) & (ts < F.date_add(hi, 1))
    wanted = F.array(
        *[F.struct(F.lit(q).alias("query"), tokenize(F.lit(q)).alias("words")) for q in queries]
    )
    keep = [c for c in articles.columns if c != "query"]
    # Through a one-element array, or the tokenizer would run for every word compared.
    matching = F.get(
        F.transform(
            F.array(tokenize(text)),
            lambda tokens: F.filter(
                wanted,
                lambda q: (F.size(q["words"]) > 0) & F.forall(q["words"], lambda word: F.array_contains(tokens, word)),
            ),
        ),
        F.lit(0),
    )
    matched = (
        within_months(articles, time_col, lo, hi)
        .filter(in_range)
        .withColumns({"_day": ts.cast("date"), "_match": F.explode_outer(matching["query"])})
        .filter(F.col("_match").isNotNull())
    )
    if monthly:
        range_start, range_end = F.greatest(F.trunc("_day", "MM"), lo), F.least(F.last_day("_day"), hi)
    else:
        range_start, range_end = lo, hi
    return matched.select(
        F.col("_match").alias("query"), range_start.alias("range_start"), range_end.alias("range_end"), *keep
    )


def keyed_queries(articles: DataFrame, queries: DataFrame, text: Column | str = "text") -> DataFrame:
    """(query_id, words, key): each query's distinct words and the one that fewest articles hold.

    Only the words that queries ask for are counted, with partial counts before
    the shuffle. Queries without words, or with one that no article holds, can
    match nothing and are left out.
    """
    words = queries.select("query_id", F.array_distinct(tokenize("query")).alias("words")).filter(F.size("words") > 0)
    each = words.select("query_id", F.size("words").alias("_n"), F.explode("words").alias("word"))
    asked = each.select("word").distinct()
    held = articles.select(F.explode_outer(F.array_distinct(tokenize(text))).alias("word"))
    counts = held.join(_sized(asked), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    rarest = each.join(counts, "word").groupBy("query_id").agg(
        F.min(F.struct("df", "word")).alias("_rarest"), F.count(F.lit(1)).alias("_found"), F.first("_n").alias("_n")
    )
    rarest = rarest.filter("_found = _n").select("query_id", F.col("_rarest.word").alias("key"))
    return words.join(rarest, "query_id")


def _sized(side: DataFrame) -> DataFrame:
    """A table to be broadcast if it is small, counting no further than that."""
    return F.broadcast(side) if is_small(side) else side


def search_table(
    articles: DataFrame,
    queries: DataFrame,
    start: str,
    end: str,
    monthly: bool = True,
    text: str = "text",
    time_col: str = "published_at",
    id_col: str = "doc_id",
) -> DataFrame:
    """The articles that match each query of a table (query_id, query), as ``search_articles`` finds them for a list.

    Rows: query_id, range_start, range_end and the article's columns. The plan
    does not grow with the queries, and no article meets queries of which it
    lacks the rarest word: articles' distinct words are joined to the queries'
    rarest ones, and the few pairs this leaves are verified against the
    article's words in its row. A small table of queries or pairs is broadcast;
    a larger one is joined by a shuffle, where adaptive execution splits frequent
    words. ``query_id`` and ``id_col`` must be unique; NULL queries and texts
    hold no words.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    ts = parsed_time(articles, time_col)
    ranged = within_months(articles, time_col, lo, hi).filter((ts >= lo) & (ts < F.date_add(hi, 1)))
    keyed = store(keyed_queries(ranged, queries.select("query_id", "query"), text))
    keys = keyed.select("query_id", "key")
    held = ranged.select(id_col, F.explode_outer(F.array_distinct(tokenize(text))).alias("key"))
    pairs = store(held.join(_sized(keys), "key").select("query_id", F.col(id_col).alias("_id")))
    rows = ranged.select("*", ts.cast("date").alias("_day"), tokenize(text).alias("_tokens"))
    matched = rows.join(_sized(pairs), F.col(id_col) == F.col("_id")).join(_sized(keyed.select("query_id", "words")), "query_id")
    # Arrays are hashed for the difference; looking up word by word would pass over the tokens for each.
    verified = matched.filter(F.size(F.array_except("words", "_tokens")) == 0)
    if monthly:
        range_start, range_end = F.greatest(F.trunc("_day", "MM"), lo), F.least(F.last_day("_day"), hi)
    else:
        range_start, range_end = lo, hi
    keep = [c for c in articles.columns if c not in ("query_id", "range_start", "range_end")]
    return verified.select("query_id", range_start.alias("range_start"), range_end.alias("range_end"), *keep)


def oldest_first(
    matches: DataFrame,
    page_size: int | None = None,
    max_pages: int | None = None,
    time_col: str = "published_at",
    id_col: str = "doc_id",
) -> DataFrame:
    """The oldest rows of each search, as many as its pages hold."""
    order = [parsed_time(matches, time_col).asc(), F.col(id_col).asc()]
    cap = page_cap(page_size, max_pages)
    return top_n(matches, ["query", "range_start"], order, cap, rank_col="position", slice_by=[id_col])


def tag_search(articles: DataFrame, query: str) -> DataFrame:
    """Mark rows with the query that found them."""
    return articles.withColumn("query", F.lit(query))


def tag_searches(articles: DataFrame, words: Sequence[str], text: str = "text") -> DataFrame:
    """One row per article and word of ``words`` in its text, marked with it: several searches appended, in one scan."""
    wanted = F.array(*(F.lit(w) for w in words))
    # Through a one-element array, or the tokenizer would run for every word compared.
    found = F.get(
        F.transform(F.array(tokenize(text)), lambda tokens: F.filter(wanted, lambda w: F.array_contains(tokens, w))), F.lit(0)
    )
    return articles.withColumn("query", F.explode_outer(found)).filter("query IS NOT NULL")


def append_searches(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Results of several searches one after another; duplicates are kept."""
    for more in rest:
        first = first.unionByName(more)
    return first


def dedup_articles(
    articles: DataFrame, key: str = "url", time_col: str = "published_at", id_col: str = "doc_id"
) -> DataFrame:
    """One row per ``key``: the earliest, then the lowest id. Rows whose key is missing or blank stay.

    Each task keeps one row per key before the shuffle, so a URL shared by a
    third of all rows costs one row per task.
    """
    unkeyed = F.when(is_blank(key), F.col(id_col))
    order = [parsed_time(articles, time_col).asc_nulls_last(), F.col(id_col).asc()]
    kept = top_n(articles.withColumn("_unkeyed", unkeyed), [key, "_unkeyed"], order, 1, rank_col="_rank")
    return kept.drop("_unkeyed", "_rank")


def daily_quota(log: DataFrame, limit: int = DAILY_LIMIT, ts_col: str = "ts") -> DataFrame:
    """Requests made and left per calendar day."""
    per_day = log.groupBy(F.col(ts_col).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("requests"))
    return per_day.withColumn("remaining", F.greatest(F.lit(0), F.lit(limit) - F.col("requests")))


def admit_requests(
    log: DataFrame, limit: int = DAILY_LIMIT, ts_col: str = "ts", id_col: str = "request_id"
) -> DataFrame:
    """The requests of each day that fall within the limit, numbered in time order."""
    days = log.withColumn("day", F.col(ts_col).cast("date"))
    return top_n(days, ["day"], [F.col(ts_col).asc(), F.col(id_col).asc()], limit, "request_no", slice_by=[id_col])


def cut_queries(queries: Sequence[str], remaining: int) -> list[str]:
    """The queries that still fit into today's remaining requests."""
    return list(queries)[: max(0, remaining)]
