"""Top-k search that leaves postings unread which cannot reach the k best."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_path, small_table, store
from .index import B, BROADCAST_BYTES, EPSILON, K1, LEAST_BUCKETS, ROW_BYTES, SearchIndex, bm25_idf, join_terms, load_index, new_table, part_of, smoothed_idf
from .search import TOP_K, Queries, _filled, _looked_up, _matches_only, _ordered, _QueryBatch, _top_k
from .topn import top_n

# Documents of a zone, postings of a block, and the least zones that the first pass of a search reads for every query.
ZONE_DOCS, BLOCK_POSTINGS, FIRST_ZONES = 1024, 64, 4
# Bytes of postings that one task puts into blocks (about 12 times that in its memory), the bytes of one posting, folders by term.
FILE_BYTES, POSTING_BYTES, PARTS = 32 << 20, 16, 4
# Zones that a search may name to the scan, which then opens the files of those alone.
NAMED_ZONES = 1000
# Scores are compared after rounding to 9 digits, so bounds this far below the threshold are still read.
MARGIN = 1e-8


@dataclass(frozen=True)
class BoundIndex:
    """A search index whose postings lie in blocks, each with what bounds its scores.

    ``blocks`` has one row per (term, zone, block): ``n`` postings, the greatest
    ``tf``, the least ``length`` and the greatest ``share`` (tf / norm) among
    them, and the postings themselves as an array. A zone is a fixed set of about
    ``ZONE_DOCS`` documents; within one, a term's postings are in the order of
    their impact, so later blocks bound lower.
    """

    index: SearchIndex
    blocks: DataFrame
    parts: int
    zones: int


def zone_of(id_col: str, zones: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("zone"), id_col), F.lit(zones)).cast("int")


def _blocks(index: SearchIndex, zones: int, parts: int, buckets: int, block: int) -> DataFrame:
    # Sorted as structs: the impact first, then the document, for one order.
    tf, length = F.col("tf"), F.col("length")
    impact = tf / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / F.lit(max(index.average_length, 1e-9))))
    posting = F.struct((-impact).alias("order"), F.col(index.id_col).alias("id"), "tf", "length", (tf / F.col("norm")).alias("share"))
    # Zones meet in their bucket once: lists are gathered, cut and written there.
    zoned = index.postings.withColumn("zone", zone_of(index.id_col, zones)).repartition(buckets, "zone")
    lists = zoned.groupBy("term", "zone").agg(F.sort_array(F.collect_list(posting)).alias("_list"))
    cut = F.transform(F.sequence(F.lit(0), F.size("_list") - 1, F.lit(block)), lambda i: F.slice("_list", i + 1, block))
    rows = lists.select("term", "zone", F.posexplode(cut).alias("block", "_own"))
    own = F.col("_own")
    return rows.select(
        "term",
        "zone",
        "block",
        F.size(own).alias("n"),
        F.array_max(own["tf"]).alias("max_tf"),
        F.array_min(own["length"]).alias("min_length"),
        F.array_max(own["share"]).alias("max_share"),
        F.transform(own, lambda p: F.struct(p["id"].alias("id"), p["tf"].alias("tf"), p["length"].alias("length"), p["share"].alias("share"))).alias("postings"),
        part_of("term", parts).alias("part"),
    )


def fit_bounds(
    index: SearchIndex, path: str | None = None, zone_docs: int = ZONE_DOCS, block: int = BLOCK_POSTINGS, file_bytes: int = FILE_BYTES
) -> BoundIndex:
    """Store the postings of ``index`` in blocks below ``path``, a new folder all executors reach.

    A list that is gathered holds one term's postings in one zone, at most the
    zone's documents; however frequent a term is, it meets no task whole. The
    postings are shuffled once, by zone, into buckets of about ``file_bytes``,
    so a task's share does not grow with the index.
    """
    spark = index.docs.sparkSession
    path = path or new_path(spark)
    zones = max(1, math.ceil(index.n_docs / zone_docs))
    n = index.postings.count()
    buckets = max(LEAST_BUCKETS, math.ceil(n * POSTING_BYTES / file_bytes))
    parts = PARTS
    rows = _blocks(index, zones, parts, buckets, block)
    table = new_table("blocks")
    rows.write.format("parquet").partitionBy("part").bucketBy(buckets, "zone").sortBy("term", "zone", "block").option("path", f"{path}/blocks").saveAsTable(table)
    settings = small_table(spark, [(parts, zones, buckets)], "parts int, zones int, buckets int")
    store(settings, f"{path}/settings")
    return BoundIndex(index, spark.table(table), parts, zones)


def load_bounds(spark: SparkSession, index_path: str, path: str) -> BoundIndex:
    """The blocks that ``fit_bounds`` stored at ``path`` over the index stored at ``index_path``."""
    index = load_index(spark, index_path)
    settings = spark.read.parquet(f"{path}/settings").first()
    id_type = index.docs.schema[index.id_col].dataType.simpleString()
    table = new_table("blocks")
    spark.sql(
        f"CREATE TABLE {table} (term STRING, zone INT, block INT, n INT, max_tf INT, min_length INT, max_share DOUBLE, "
        f"postings ARRAY<STRUCT<id: {id_type}, tf: INT, length: INT, share: DOUBLE>>, part INT) USING parquet "
        f"PARTITIONED BY (part) CLUSTERED BY (zone) SORTED BY (term, zone, block) INTO {settings['buckets']} BUCKETS LOCATION '{path}/blocks'"
    )
    spark.catalog.recoverPartitions(table)
    return BoundIndex(index, spark.table(table), settings["parts"], settings["zones"])


@dataclass(frozen=True)
class _Ranker:
    """Weights (query_id, term, _weight) and what a posting, or at most a block, adds for a weight."""

    weights: DataFrame
    score: Column
    bound: Column


def _bm25(index: SearchIndex, batch: _QueryBatch, k1: float, b: float, epsilon: float) -> _Ranker:
    idf = _looked_up(bm25_idf(index, epsilon), batch)
    weights = batch.terms.join(idf, "term").select("query_id", "term", (F.col("n") * F.col("idf")).alias("_weight"))

    def added(tf: str, length: str) -> Column:
        # Grows with tf and falls with length, so a block's extremes bound its postings for any k1 and b.
        damped = F.col(tf) + F.lit(float(k1)) * (F.lit(1.0 - b) + F.lit(float(b)) * F.col(length) / index.average_length)
        return F.col("_weight") * F.col(tf) * (k1 + 1) / damped

    return _Ranker(weights, added("tf", "length"), added("max_tf", "min_length"))


def _tfidf(index: SearchIndex, batch: _QueryBatch) -> _Ranker:
    if not index.n_vocabulary:
        raise ValueError("no terms remain after stop words and document-frequency pruning")
    idf = smoothed_idf(index, **index.options).select("term", "idf")
    raw = batch.terms.join(_looked_up(idf, batch), "term").withColumn("_w", F.col("n") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("query_id")))
    weights = raw.select("query_id", "term", (F.col("_w") / norm * F.col("idf")).alias("_weight"))
    return _Ranker(weights, F.col("_weight") * F.col("share"), F.col("_weight") * F.col("max_share"))


def _scored(blocks: DataFrame, chosen: DataFrame, ranker: _Ranker, id_col: str) -> DataFrame:
    """(query_id, id, score) over the blocks (query_id, _weight, term, zone, block) chosen for each query.

    Blocks are dropped before their postings are listed. Choices of checked size
    go to the blocks, which then stay where they are read.
    """
    size = chosen.agg(F.coalesce(F.sum(F.octet_length("term").cast("long") + ROW_BYTES), F.lit(0)).alias("n")).first()["n"]
    chosen = F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen
    rows = blocks.select("term", "zone", "block", "postings").join(chosen, ["term", "zone", "block"])
    rows = rows.select("query_id", "zone", "_weight", F.explode("postings").alias("p")).select("query_id", "zone", "_weight", "p.*")
    # A document lies in one zone; with the zone among the keys, scores add up where a bucket of zones is read.
    return rows.groupBy("query_id", "zone", F.col("id").alias(id_col)).agg(F.sum(ranker.score).alias("score")).drop("zone")


@dataclass(frozen=True)
class BoundSearch:
    """A search's ``results``, and its blocks: all that its words have (``offered``) and those read (``read``)."""

    results: DataFrame
    offered: DataFrame
    read: DataFrame


def bounded_search(
    bounds: BoundIndex,
    queries: Queries,
    ranker: str = "bm25",
    k: int = TOP_K,
    fill_zero: bool = True,
    k1: float = K1,
    b: float = B,
    epsilon: float = EPSILON,
    first_zones: int = FIRST_ZONES,
) -> BoundSearch:
    """The rows of ``bm25_search`` or ``tfidf_search``, without reading postings that cannot change them.

    The blocks' bounds alone are read first (no posting is). A document scores
    at most the sum of its zone's bounds, so the zones that promise most are
    scored in full, and the k-th best score there is a threshold: of every other
    zone a block is read only if its own bound and the best bounds of the
    query's other words in that zone reach it. Whatever a skipped block holds is
    below the k best, and every document among them is in none, so its score is
    whole. Rare words leave most zones without a promise, and frequent words are
    not read there. Where weights are negative (a mean idf below zero) bounds say
    nothing and all blocks are read.
    """
    index, id_col = bounds.index, bounds.index.id_col
    batch = _QueryBatch(index, queries)
    model = {"bm25": lambda: _bm25(index, batch, k1, b, epsilon), "tfidf": lambda: _tfidf(index, batch)}[ranker]()
    wanted = batch.vocabulary.select(part_of("term", bounds.parts).alias("part")).distinct().collect()  # at most the folders
    blocks = bounds.blocks.filter(F.col("part").isin([r["part"] for r in wanted]))
    heads = blocks.drop("postings")
    offered = store(
        join_terms(heads, model.weights, batch.small).select("query_id", "term", "_weight", "zone", "block", "n", model.bound.alias("bound"))
    )
    negative = ranker == "bm25" and index.mean_idf < 0
    read = offered if negative else store(_promising(blocks, offered, model, id_col, k, first_zones))
    if read is not offered:
        blocks = _named_zones(blocks, read)
    scores = _scored(blocks, read.select("query_id", "term", "zone", "block", "_weight"), model, id_col)
    if fill_zero:
        results = _filled(index, batch, scores, k, negative)
    else:
        results = _top_k(_matches_only(scores), id_col, k)
    return BoundSearch(results, offered, read)


def _promising(blocks: DataFrame, offered: DataFrame, model: _Ranker, id_col: str, k: int, first_zones: int) -> DataFrame:
    """The offered blocks that may hold a document among the k best of their query."""
    words = offered.groupBy("query_id", "zone", "term").agg(F.max("bound").alias("_word"))
    zones = store(words.groupBy("query_id", "zone").agg(F.sum("_word").alias("_zone")))
    # Each such zone holds a match, so k of them hold the k documents a threshold needs.
    first = top_n(zones, ["query_id"], [F.desc("_zone"), F.asc("zone")], max(k, first_zones), slice_by=["zone"]).select("query_id", "zone")
    chosen = store(offered.join(first, ["query_id", "zone"]).select("query_id", "term", "zone", "block", "_weight"))
    best = top_n(_scored(_named_zones(blocks, chosen), chosen, model, id_col), ["query_id"], _ordered(id_col), k, slice_by=[id_col])
    least = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_least"))
    thresholds = least.filter(F.col("_n") >= k).select("query_id", "_least")
    known = offered.join(zones, ["query_id", "zone"]).join(words, ["query_id", "zone", "term"]).join(thresholds, "query_id", "left")
    reach = F.col("_zone") - F.col("_word") + F.col("bound")
    kept = known.filter(F.col("_least").isNull() | (reach >= F.col("_least") - MARGIN))
    return kept.select("query_id", "term", "_weight", "zone", "block", "n", "bound")


def _named_zones(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """``blocks`` with the chosen zones as constants, if they are few: files of other zones are not opened."""
    zones = [r["zone"] for r in chosen.select("zone").distinct().limit(NAMED_ZONES + 1).collect()]
    return blocks.filter(F.col("zone").isin(zones)) if len(zones) <= NAMED_ZONES else blocks
