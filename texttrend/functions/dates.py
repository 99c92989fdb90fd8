"""Calendar expressions: month splitting, bucket labels, timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FREQUENCIES = ("ME", "W", "D")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(d: Column | str) -> Column:
    return (F.lit(d) if isinstance(d, str) else d).cast("date")


def month_ranges(start: Column | str, end: Column | str) -> Column:
    """Array of (range_start, range_end): one entry per calendar month.

    The first entry starts at ``start`` itself, the last one ends at ``end``;
    an array without entries when ``start`` is after ``end``.
    """
    lo, hi = _date(start), _date(end)
    months = F.sequence(F.trunc(lo, "MM"), F.greatest(lo, hi), F.expr("interval 1 month"))
    ranges = F.transform(
        months,
        lambda m: F.struct(
            F.greatest(m, lo).alias("range_start"),
            F.least(F.last_day(m), hi).alias("range_end"),
        ),
    )
    return F.filter(ranges, lambda r: r["range_start"] <= hi)


def compact_date(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyyMMdd")


def month_label(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def month_number(ts: Column) -> Column:
    """202403 for March 2024; the value article tables are partitioned by."""
    return F.year(ts) * 100 + F.month(ts)


def bucket_end(ts: Column, freq: str) -> Column:
    """Last day of the calendar bucket: month end, Sunday, or the day itself."""
    day = ts.cast("date")
    if freq == "ME":
        return F.last_day(day)
    if freq == "W":
        return F.next_day(F.date_sub(day, 1), "SUN")
    if freq == "D":
        return day
    raise ValueError(f"freq must be one of {FREQUENCIES}, not {freq!r}")


def parsed_time(df: DataFrame, time_col: str) -> Column:
    """``time_col`` as a timestamp: strings are parsed (unparsable gives NULL)."""
    kind = df.schema[time_col].dataType.typeName()
    if kind == "string":
        return F.col(time_col).try_cast("timestamp")
    return F.col(time_col)


# Tables written with this column as partitions hold the month number of ``published_at`` in it.
MONTH_COL = "published_month"


def within_months(df: DataFrame, time_col: str, lo: Column, hi: Column) -> DataFrame:
    """``df`` without partitions of other months, where it is partitioned by month; row filters still apply."""
    if time_col != "published_at" or MONTH_COL not in df.columns:
        return df
    return df.filter(F.col(MONTH_COL).between(month_number(lo), month_number(hi)))
