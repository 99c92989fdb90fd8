"""Score statistics kept as mergeable states, so that reports read states and not articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import bucket_end, month_label, parsed_time
from ..functions.labels import drop_nan
from .trends import TREND_END, TREND_START, _spine

COUNTS = ("n", "positive", "negative", "neutral")
BATCH = "batch"


def score_states(scored: DataFrame, keys: Sequence[str] = (), value_col: str = "sentiment", pos_th: float = 0.1, neg_th: float = -0.1) -> DataFrame:
    """One state per ``keys``: n scores, their mean, ``m2`` (the squared distances from it added up), and counts by label.

    Missing scores count nowhere; a key without scores has n = 0 and a mean of 0.
    """
    v = drop_nan(value_col)
    count = lambda condition: F.count(F.when(condition, 1))
    return scored.groupBy(*keys).agg(
        F.count(v).alias("n"),
        F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("m2"),
        count(v > pos_th).alias("positive"),
        count(v < neg_th).alias("negative"),
        count((v >= neg_th) & (v <= pos_th)).alias("neutral"),
    )


def merge_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States of fewer ``keys``, by the formula for the variance of joined samples.

    Means are weighted by n; ``m2`` is that of the parts plus n times the squared
    distance of each part's mean from the joint one. Both are sums, so partial
    sums travel, and no difference of large squares is taken.
    """
    weighted = F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    means = states.groupBy(*keys).agg(F.when(F.sum("n") > 0, weighted).otherwise(0.0).alias("_mean"))
    renamed = means.select(*[F.col(k).alias(f"_{k}") for k in keys], "_mean")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    # One row per key on the right; without keys a single one, read as a constant.
    beside = states.join(renamed, same) if keys else states.withColumn("_mean", means.scalar())
    apart = F.col("mean") - F.col("_mean")
    merged = beside.groupBy(*keys).agg(
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
        *(F.sum(c).alias(c) for c in COUNTS),
    )
    if not keys:  # no states at all are a state without scores
        merged = merged.select(*(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("mean", "m2")), *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS))
    return merged.select(*keys, "n", "mean", "m2", "positive", "negative", "neutral")


def distribution_of(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of ``sentiment_distribution`` of the articles behind the states."""
    merged = merge_states(states, keys)
    n = F.col("n")
    filled = lambda c: F.when(n == 0, 0.0).otherwise(c)
    return merged.select(
        *keys,
        filled(F.col("mean")).alias("mean_sentiment"),
        F.when(n == 0, 0.0).when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std_sentiment"),
        *(filled(F.col(c) / n).alias(f"{c}_ratio") for c in ("positive", "negative", "neutral")),
    )


def daily_states(scored: DataFrame, keys: Sequence[str] = (), time_col: str = "published_at", **options) -> DataFrame:
    """States by ``day`` and ``keys``; rows without a readable time have a NULL day."""
    return score_states(scored.withColumn("day", parsed_time(scored, time_col).cast("date")), ["day", *keys], **options)


def trend_of(states: DataFrame, freq: str = "ME", start: str = TREND_START, end: str = TREND_END) -> DataFrame:
    """The rows of ``sentiment_trend(end_inclusive="day")``, from daily states."""
    ranged = states.filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    buckets = merge_states(ranged.withColumn("bucket", bucket_end(F.col("day"), freq)), ["bucket"])
    means = buckets.select("bucket", F.when(F.col("n") > 0, F.col("mean")).alias("sentiment"), "n")
    label = month_label("bucket") if freq == "ME" else F.date_format("bucket", "yyyy-MM-dd")
    # At most one row per bucket of the range, whatever the input's size.
    return (
        _spine(states, start, end, freq)
        .join(F.broadcast(means), "bucket", "left")
        .select("bucket", label.alias("label"), "sentiment", F.coalesce("n", F.lit(0)).alias("n"))
    )


def update_states(states: DataFrame, path: str, batch: str) -> None:
    """Store the states of one batch of articles; a batch that is run again replaces its own and no other."""
    states.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of all batches, as many rows as batches have keys."""
    return spark.read.option("basePath", path).parquet(path).drop(BATCH)


def compact_states(spark: SparkSession, path: str, target: str, keys: Sequence[str]) -> None:
    """Merge the states of all batches below ``path`` into one batch of a new folder."""
    update_states(merge_states(read_states(spark, path), keys), target, "compacted")
