"""Score distributions and gap-filled time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import bucket_end, month_label, parsed_time, within_months
from ..functions.labels import drop_nan

# The default trend range; its end is the first instant of that day.
TREND_START = "2024-01-01"
TREND_END = "2024-12-31"


def sentiment_distribution(
    df: DataFrame,
    keys: Sequence[str] = (),
    value_col: str = "sentiment",
    pos_th: float = 0.1,
    neg_th: float = -0.1,
) -> DataFrame:
    """Mean, sample deviation and positive/negative/neutral shares, missing scores left out.

    One row per ``keys``, or one in all. Five zeros without scores; the
    deviation of a single score is NULL.
    """
    if value_col not in df.columns:
        raise ValueError(f"no column {value_col!r} to summarise")
    v = drop_nan(value_col)
    n = F.count(v)

    def share(condition: Column) -> Column:
        return F.avg(F.when(v.isNotNull(), F.when(condition, 1.0).otherwise(0.0)))

    statistics = {
        "mean_sentiment": F.avg(v),
        "std_sentiment": F.stddev_samp(v),
        "positive_ratio": share(v > pos_th),
        "negative_ratio": share(v < neg_th),
        "neutral_ratio": share((v >= neg_th) & (v <= pos_th)),
    }
    return df.groupBy(*keys).agg(*[F.when(n == 0, 0.0).otherwise(s).alias(name) for name, s in statistics.items()])


def split_unparsed(df: DataFrame, time_col: str = "published_at") -> tuple[DataFrame, DataFrame]:
    """(rows with a usable or blank time, rows whose non-blank time cannot be read)."""
    bad = parsed_time(df, time_col).isNull() & (F.coalesce(F.trim(F.col(time_col).cast("string")), F.lit("")) != "")
    return df.filter(~bad), df.filter(bad)


def time_filter(
    df: DataFrame,
    time_col: str = "published_at",
    start: str = TREND_START,
    end: str = TREND_END,
    end_inclusive: str = "instant",
) -> DataFrame:
    """Rows from ``start`` to ``end``, both inclusive; missing times drop out.

    With ``end_inclusive="instant"`` the range stops at midnight beginning the
    last day; ``"day"`` includes all of it. The bounds are literals of the
    column's own type, so Parquet scans filter on them; of article tables
    partitioned by month only those months are read.
    """
    if end_inclusive not in ("instant", "day"):
        raise ValueError("end_inclusive must be 'instant' or 'day'")
    kind = "timestamp_ntz" if df.schema[time_col].dataType.typeName() == "timestamp_ntz" else "timestamp"
    ts, lo, hi = parsed_time(df, time_col), F.lit(start).cast(kind), F.lit(end).cast(kind)
    last = ts <= hi if end_inclusive == "instant" else ts < hi + F.expr("interval 1 day")
    return within_months(df, time_col, lo, hi).filter((ts >= lo) & last)


def _spine(df: DataFrame, start: str, end: str, freq: str) -> DataFrame:
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    step = {"ME": "interval 1 month", "W": "interval 7 days", "D": "interval 1 day"}[freq]
    first, last = bucket_end(lo, freq), bucket_end(hi, freq)
    if freq == "ME":
        # Month starts are stepped, then moved to their ends: stepping ends would drift.
        first, last = F.trunc(first, "MM"), F.trunc(last, "MM")
    days = F.sequence(first, last, F.expr(step))
    one_row = df.sparkSession.range(1)
    return one_row.select(F.explode(days).alias("day")).select(
        (F.last_day("day") if freq == "ME" else F.col("day")).alias("bucket")
    )


def sentiment_trend(
    df: DataFrame,
    time_col: str = "published_at",
    value_col: str = "sentiment",
    freq: str = "ME",
    start: str = TREND_START,
    end: str = TREND_END,
    end_inclusive: str = "instant",
) -> DataFrame:
    """Mean score per calendar bucket, every bucket of the range present.

    ``freq`` is "ME" (labelled by month end), "W" (by its Sunday) or "D".
    Columns: bucket, label, sentiment (NULL when empty), n (scores averaged).
    """
    ranged = time_filter(df, time_col, start, end, end_inclusive)
    v = drop_nan(value_col)
    means = ranged.groupBy(bucket_end(parsed_time(ranged, time_col), freq).alias("bucket")).agg(
        F.avg(v).alias("sentiment"), F.count(v).alias("n")
    )
    label = month_label("bucket") if freq == "ME" else F.date_format("bucket", "yyyy-MM-dd")
    # At most one row per bucket of the range, whatever the input's size.
    return (
        _spine(df, start, end, freq)
        .join(F.broadcast(means), "bucket", "left")
        .select("bucket", label.alias("label"), "sentiment", F.coalesce("n", F.lit(0)).alias("n"))
    )
