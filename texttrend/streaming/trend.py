"""Trends, admission and deduplication over streams.

Spark's windows have a fixed length, which calendar months do not: either the
stream emits days and months are summed from stored days, or months keep states
and timers of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label, parsed_time
from ..functions.labels import drop_nan
from ..operators.retrieval import is_blank


def _timed(stream: DataFrame, time_col: str, delay: str) -> DataFrame:
    # Watermarks need a timestamp; strings and zoneless timestamps are converted.
    return stream.withColumn("_ts", parsed_time(stream, time_col).cast("timestamp")).withWatermark("_ts", delay)


def daily_sums(
    stream: DataFrame, time_col: str = "published_at", value_col: str = "sentiment", delay: str = "2 days"
) -> DataFrame:
    """(day, total, n) for append mode: a day is emitted once, ``delay`` after its end."""
    v = drop_nan(value_col)
    days = _timed(stream, time_col, delay).groupBy(F.window("_ts", "1 day"))
    sums = days.agg(F.sum(v).alias("total"), F.count(v).alias("n"))
    return sums.select(F.col("window.start").cast("date").alias("day"), "total", "n")


def monthly_means(days: DataFrame) -> DataFrame:
    """(bucket, label, sentiment, n) per month of stored daily sums."""
    months = days.groupBy(F.last_day("day").alias("bucket")).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    return months.select("bucket", month_label("bucket").alias("label"), mean.alias("sentiment"), "n")


def dedup_stream(
    stream: DataFrame, key: str = "url", time_col: str = "published_at", delay: str = "2 days"
) -> DataFrame:
    """The first arrival of each ``key`` within ``delay``; state older than that is dropped.

    Rows whose key is missing or blank pass through, as in the batch version.
    """
    timed = _timed(stream, time_col, delay)
    once = timed.filter(~is_blank(key)).dropDuplicatesWithinWatermark([key])
    return once.unionByName(timed.filter(is_blank(key))).drop("_ts")


# ---- stateful streams ---------------------------------------------------------------------


STATE = "n long, mean double, m2 double, positive long, negative long, neutral long"
SALTS = 64  # groups that one month's rows are dealt into, merged when states are read


def monthly_states(
    stream: DataFrame,
    time_col: str = "published_at",
    value_col: str = "sentiment",
    delay: str = "2 days",
    pos_th: float = 0.1,
    neg_th: float = -0.1,
    salts: int = SALTS,
) -> DataFrame:
    """(day, n, mean, m2, positive, negative, neutral) per calendar month and salt, for append mode.

    Windows have a fixed length and months do not, so each month keeps a state of
    its own and a timer at its end; it is emitted once the watermark has passed
    that. ``day`` is the month's last. States are those of ``operators.states``:
    the parts of a month are merged when read, so a month that holds all rows
    is still many groups. Rows later than ``delay`` are left out, and rows
    without a readable time.
    """
    timed = _timed(stream, time_col, delay).filter(F.col("_ts").isNotNull())
    rows = timed.select(
        F.last_day(F.col("_ts").cast("date")).alias("day"),
        F.pmod(F.xxhash64("_ts", value_col), F.lit(salts)).cast("int").alias("salt"),
        "_ts",
        drop_nan(value_col).cast("double").alias("_v"),
    )

    def fold(key, batches, state):
        import calendar
        import datetime

        import pandas as pd

        if state.hasTimedOut:
            kept = state.get
            state.remove()
            yield pd.DataFrame([(*key, *kept)], columns=["day", "salt", "n", "mean", "m2", "positive", "negative", "neutral"])
            return
        n, mean, m2, positive, negative, neutral = state.get if state.exists else (0, 0.0, 0.0, 0, 0, 0)
        for batch in batches:
            v = batch["_v"].dropna()
            if len(v):
                many, centre = len(v), float(v.mean())
                away, both = centre - mean, n + many
                m2 += float(((v - centre) ** 2).sum()) + away * away * n * many / both
                mean += away * many / both
                n, positive, negative = both, positive + int((v > pos_th).sum()), negative + int((v < neg_th).sum())
                neutral += int(((v >= neg_th) & (v <= pos_th)).sum())
        state.update((n, mean, m2, positive, negative, neutral))
        over = key[0] + datetime.timedelta(days=1)
        state.setTimeoutTimestamp(max(calendar.timegm(over.timetuple()) * 1000, state.getCurrentWatermarkMs() + 1))

    output = f"day date, salt int, {STATE}"
    return rows.groupBy("day", "salt").applyInPandasWithState(fold, output, STATE, "append", "EventTimeTimeout").drop("salt")


def daily_candidates(
    stream: DataFrame, limit: int, ts_col: str = "ts", id_col: str = "request_id", delay: str = "1 hour", salts: int = SALTS
) -> DataFrame:
    """(request_id, ts) of the first ``limit`` requests of each day and salt, for append mode.

    A state never holds more than ``limit`` requests, and is emitted when the
    watermark has passed the day. The first of a whole day are among these:
    ``admit_requests`` of the stored rows numbers them. Rows without a time or an
    id are not admitted.
    """
    timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", delay)
    timed = timed.filter(F.col("_ts").isNotNull())
    rows = timed.select(
        F.col("_ts").cast("date").alias("day"),
        F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("salt"),
        "_ts",
        F.unix_micros("_ts").alias("at"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        # Left out in the state: a filter here would move below the watermark, which their times still advance.
        F.col(id_col).isNotNull().alias("known"),
    )

    def first(key, batches, state):
        import calendar
        import datetime
        import heapq

        import pandas as pd

        if state.hasTimedOut:
            at, ids = state.get
            state.remove()
            yield pd.DataFrame({"id": ids, "at": at})
            return
        kept = list(zip(*state.get)) if state.exists else []
        for batch in batches:
            batch = batch[batch["known"]]
            kept = heapq.nsmallest(limit, [*kept, *zip(batch["at"].tolist(), batch["id"].tolist())])
        state.update(([a for a, _ in kept], [i for _, i in kept]))
        over = key[0] + datetime.timedelta(days=1)
        state.setTimeoutTimestamp(max(calendar.timegm(over.timetuple()) * 1000, state.getCurrentWatermarkMs() + 1))

    found = rows.groupBy("day", "salt").applyInPandasWithState(first, "id long, at long", "at array<long>, ids array<long>", "append", "EventTimeTimeout")
    return found.select(F.col("id").alias(id_col), F.timestamp_micros("at").alias(ts_col))


def run_to_end(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append what a stream emits for all input there is now to a Parquet folder; run again, it goes on from there."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", out)
    writer.trigger(availableNow=True).start().awaitTermination()
