"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root): each node that has a link and the smallest node it can reach.

    Every round joins each node's smallest neighbour to its larger neighbours
    and then to its smaller ones, which halves distances; the edges of a round
    are written to the shared folder, so that a lost executor costs one round.
    Minima are pre-aggregated, and only joins (which adaptive execution splits)
    see the many links of one node. No link reaches the driver. An empty table
    gives an empty table; self links and NULL ends are ignored.
    """
    edges = store(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = store(small)
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
