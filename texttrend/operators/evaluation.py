"""Relevance judging, ranking metrics, and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import drop_nan
from .topn import top_n


def relevance(query: Column | str, article_query: Column | str) -> Column:
    """1.0 when either string contains the other, ignoring case, else 0.0."""
    a = F.lower(F.coalesce(F.col(query) if isinstance(query, str) else query, F.lit("")))
    b = F.lower(F.coalesce(F.col(article_query) if isinstance(article_query, str) else article_query, F.lit("")))
    return F.when(F.contains(a, b) | F.contains(b, a), 1.0).otherwise(0.0)


def judge(results: DataFrame, articles: DataFrame, queries: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add ``query`` and ``rel`` to ranked results: was the article collected for this query?

    Results are k rows per query, the small side of the join with the articles,
    of which only the key and ``query`` are read. Store the results first:
    metrics read them more than once.
    """
    asked = results.join(queries.select("query_id", "query"), "query_id")
    found = articles.select(id_col, F.col("query").alias("article_query"))
    return asked.join(found, id_col).withColumn("rel", relevance("query", "article_query"))


# ---- ranking metrics over (group..., rank, rel) -----------------------------------------


def _rel() -> Column:
    return drop_nan("rel")


def _within(k: int, value: Column) -> Column:
    return F.when(F.col("rank") <= k, value)


def _discounted(rank: Column) -> Column:
    return _rel() / F.log2(rank + 1)


def _precision(k: int) -> Column:
    if k <= 0:
        return F.lit(0.0)
    relevant = F.coalesce(F.sum(_within(k, F.when(_rel() > 0, 1.0))), F.lit(0.0))
    return relevant / F.least(F.lit(k), F.count(F.lit(1)))


def _reciprocal(k: int | None = None) -> Column:
    rank = F.when(_rel() > 0, F.col("rank"))
    first = F.min(rank if k is None else _within(k, rank))
    return F.coalesce(1.0 / first, F.lit(0.0))


def precision_at_k(lists: DataFrame, k: int = 10, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Share of relevant rows among the first k of each list (fewer if it is shorter)."""
    return lists.groupBy(*keys).agg(_precision(k).alias("precision_at_k"))


def _ideal_dcg(lists: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    # The k largest of the whole list; each task passes on k rows per list at most.
    best = top_n(lists.select(*keys, "rank", "rel"), keys, [_rel().desc_nulls_last(), F.col("rank")], k, "_ideal",
                 slice_by=[*keys, "rank"])
    return best.groupBy(*keys).agg(F.sum(_discounted(F.col("_ideal"))).alias("_idcg"))


def _ndcg() -> Column:
    return F.when(F.col("_idcg") > 0, F.coalesce("_dcg", F.lit(0.0)) / F.col("_idcg")).otherwise(F.lit(0.0))


def ndcg_at_k(lists: DataFrame, k: int = 10, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Discounted gain of the first k over that of the k best; 0.0 without gain."""
    keys = list(keys)
    gained = lists.groupBy(*keys).agg(F.sum(_within(k, _discounted(F.col("rank")))).alias("_dcg"))
    return gained.join(_ideal_dcg(lists, k, keys), keys, "left").select(*keys, _ndcg().alias("ndcg"))


def reciprocal_rank(lists: DataFrame, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """1 / rank of the first relevant row of each list, without a cutoff; 0.0 when there is none."""
    return lists.groupBy(*keys).agg(_reciprocal().alias("reciprocal_rank"))


def mean_reciprocal_rank(
    lists: DataFrame, keys: Sequence[str] = ("query_id",), by: Sequence[str] = (), queries: DataFrame | None = None
) -> DataFrame:
    """Mean reciprocal rank. Queries listed in ``queries`` but without rows count as 0."""
    per_query = reciprocal_rank(lists, [*by, *keys])
    if queries is not None:
        wanted = queries.select(*by, *keys).distinct()
        per_query = wanted.join(per_query, [*by, *keys], "left")
    value = F.avg(F.coalesce("reciprocal_rank", F.lit(0.0)))
    return per_query.groupBy(*by).agg(F.coalesce(value, F.lit(0.0)).alias("mrr"))


METRICS = ("mrr", "ndcg", "precision_at_k", "mean_score")


def evaluate_ranking(
    lists: DataFrame, k: int = 10, keys: Sequence[str] = ("query_id",), queries: DataFrame | None = None
) -> DataFrame:
    """MRR within k, NDCG, precision and mean relevance of each list; empty lists give zeros."""
    keys = list(keys)
    grouped = lists.groupBy(*keys).agg(
        _reciprocal(k).alias("mrr"),
        _precision(k).alias("precision_at_k"),
        F.avg(_within(k, _rel())).alias("mean_score"),
        F.sum(_within(k, _discounted(F.col("rank")))).alias("_dcg"),
    )
    report = grouped.join(_ideal_dcg(lists, k, keys), keys, "left").withColumn("ndcg", _ndcg())
    if queries is not None:
        report = queries.select(*keys).distinct().join(report, keys, "left")
    return report.select(*keys, *[F.coalesce(m, F.lit(0.0)).alias(m) for m in METRICS])


def macro_average(report: DataFrame, by: Sequence[str] = ("ranker",)) -> DataFrame:
    """Unweighted mean of the per-query metrics; mean relevance is not averaged."""
    return report.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS[:-1]])


def compare_rankers(judged: DataFrame, k: int = 10, queries: DataFrame | None = None) -> DataFrame:
    """Per-query rows and one average row (NULL query_id and query) for each ranker.

    Queries are told apart by ``query_id``; two with the same text stay two.
    Those of ``queries`` (query_id, query) for which a ranker found nothing
    count as zeros.
    """
    keys = ["ranker", "query_id", "query"]
    asked = None
    if queries is not None:
        # One row per ranker and query: an array of the few rankers exploded, not a join.
        rankers = judged.agg(F.collect_set("ranker").alias("r")).scalar()
        asked = queries.select(F.explode(rankers).alias("ranker"), "query_id", "query")
    report = evaluate_ranking(judged, k, keys=keys, queries=asked)
    # Both levels in one pass; a union would evaluate the report twice.
    levels = report.groupingSets([keys, ["ranker"]], *keys)
    return levels.agg(*[F.avg(m).alias(m) for m in METRICS[:-1]])


# ---- classification ---------------------------------------------------------------------


def confusion_counts(labelled: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(y_true, y_pred, n) for the pairs that occur."""
    pairs = labelled.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred"))
    return pairs.agg(F.count(F.lit(1)).alias("n"))


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every true or predicted class; 0/0 is 0."""
    hit = F.when(F.col("y_true").eqNullSafe(F.col("y_pred")), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    as_true = F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), zero.alias("predicted"),
                       hit.cast("long").alias("hits"))
    as_pred = F.struct(F.col("y_pred").alias("label"), zero.alias("support"), F.col("n").alias("predicted"),
                       zero.alias("hits"))
    sides = confusion.select(F.explode(F.array(as_true, as_pred)).alias("s")).select("s.*")
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])

    def ratio(num: Column, den: Column) -> Column:
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return sums.select(
        "label",
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + predicted).alias("f1_score"),
        "support",
        "hits",
    )


def classification_report(labelled: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by true-class support."""
    classes = class_metrics(confusion_counts(labelled, y_true, y_pred))
    total = F.sum("support")
    weighted = [(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in ("precision", "recall", "f1_score")]
    return classes.agg((F.sum("hits") / total).alias("accuracy"), *weighted)
