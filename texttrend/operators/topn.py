"""Exact top-n per group that never gathers a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark trims each task's rows to the first n of a group before the shuffle
# (WindowGroupLimit), for n up to this setting.
WINDOW_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SLICES = (1024, 32)


def top_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
    slice_by: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered from 1.

    Beyond Spark's own limit a hot group is first cut into slices by a hash of
    ``slice_by`` (a row key), then those into fewer; each slice keeps its first
    n rows, which must contain the group's first n. So no ranking sees more than
    32 times n rows of a group, or its 1,024th part. The rows are the same.
    """
    if n > int(df.sparkSession.conf.get(WINDOW_LIMIT, "1000")):
        if not slice_by:
            raise ValueError(f"n beyond {WINDOW_LIMIT} needs slice_by, a row key")
        sliced = Window.partitionBy(*group, "_slice").orderBy(*order)
        for slices in SLICES:
            df = (
                df.withColumn("_slice", F.pmod(F.xxhash64(*slice_by), F.lit(slices)))
                .withColumn("_in_slice", F.row_number().over(sliced))
                .filter(F.col("_in_slice") <= n)
                .drop("_slice", "_in_slice")
            )
    ranked = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(rank_col) <= n)
