"""Many-query TF-IDF and BM25 search over a stored index."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import small_table
from .index import B, BROADCAST_BYTES, EPSILON, K1, ROW_BYTES, SearchIndex, bm25_idf, join_terms, part_of, smoothed_idf
from .topn import top_n

TOP_K = 10
SCORE_DIGITS = 9
SLICE_DOCS = 1_000_000

Queries = Sequence[str] | DataFrame


class _QueryBatch:
    """Queries as a table (query_id, query), their words, and whether those may be broadcast.

    A list comes from the driver program and its texts are measured there; of a
    table the words are counted and measured.
    """

    def __init__(self, index: SearchIndex, queries: Queries):
        if isinstance(queries, DataFrame):
            self.table = queries.select(F.col("query_id").cast("long"), "query")
        else:
            rows = list(enumerate(queries))
            self.table = small_table(index.docs.sparkSession, rows, "query_id long, query string")
        # (query_id, term, n) with n the times the query repeats the term.
        words = self.table.select("query_id", F.explode_outer(tokenize("query")).alias("term"))
        words = words.filter("term IS NOT NULL")
        self.terms = words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("n"))
        self.vocabulary = self.terms.select("term").distinct()
        if isinstance(queries, DataFrame):
            each = F.octet_length("term").cast("long") + ROW_BYTES
            size = self.terms.agg(F.coalesce(F.sum(each), F.lit(0)).alias("n")).first()["n"]
        else:
            size = sum(len(q.encode()) * (1 + ROW_BYTES) for q in queries)
        self.small = size <= BROADCAST_BYTES


def _looked_up(idf: DataFrame, batch: _QueryBatch) -> DataFrame:
    """Rows of a term table for the words of the queries."""
    words = F.broadcast(batch.vocabulary) if batch.small else batch.vocabulary
    return idf.join(words, "term", "left_semi")


def _ordered(id_col: str) -> list[Column]:
    # Equal texts may differ in the last bit of a sum, so order by the rounded score.
    return [F.round("score", SCORE_DIGITS).desc(), F.col(id_col).desc()]


def _top_k(scores: DataFrame, id_col: str, k: int) -> DataFrame:
    ranked = top_n(scores, ["query_id"], _ordered(id_col), k, slice_by=[id_col])
    return ranked.select("query_id", "rank", id_col, "score")


def _zero_rows(index: SearchIndex, batch: _QueryBatch, k: int) -> DataFrame:
    """Score 0.0 for every query and the 2k highest document ids.

    A query matching fewer than k documents leaves at least k of those 2k
    unmatched, so they fill its result exactly while scores are not negative.
    The ids, 2k at most, are attached to the queries as an array.
    """
    id_col = index.id_col
    highest = index.docs.select(id_col).orderBy(F.col(id_col).desc()).limit(2 * k)
    listed = F.explode_outer(highest.agg(F.collect_list(id_col)).scalar()).alias(id_col)
    return batch.table.select("query_id", listed, F.lit(0.0).alias("score")).filter(F.col(id_col).isNotNull())


def _unmatched_rows(index: SearchIndex, batch: _QueryBatch, scores: DataFrame, k: int) -> DataFrame:
    """Score 0.0 for the k highest document ids that do not match, for every query and slice of the documents.

    Needed only when the mean idf is negative, where matches may rank below
    zeros. Documents are numbered downwards within slices of a million; the
    numbers a query leaves free are read off the gaps between its matches, so no
    query is paired with the documents it does not match.
    """
    id_col = index.id_col
    slices = max(1, math.ceil(index.n_docs / SLICE_DOCS))
    downwards = Window.partitionBy("_slice").orderBy(F.col(id_col).desc())
    numbered = index.docs.select(id_col, F.pmod(F.xxhash64(id_col), F.lit(slices)).alias("_slice"))
    numbered = numbered.withColumn("_at", F.row_number().over(downwards))
    matched = scores.select("query_id", id_col).join(numbered, id_col).select("query_id", "_slice", "_at")
    starts = batch.table.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"), F.lit(0).alias("_at"))
    places = Window.partitionBy("query_id", "_slice").orderBy("_at")
    free_before = F.col("_at") - F.row_number().over(places) + 1
    gaps = matched.unionByName(starts).select(
        "query_id", "_slice", "_at", F.lead("_at").over(places).alias("_next"), free_before.alias("_free")
    )
    last = F.least(F.coalesce(F.col("_next") - 1, F.col("_at") + k), F.col("_at") + k - F.col("_free"))
    free = gaps.withColumn("_last", last).filter("_last > _at")
    free = free.select("query_id", "_slice", F.explode(F.sequence(F.col("_at") + 1, "_last")).alias("_at"))
    return free.join(numbered, ["_slice", "_at"]).select("query_id", id_col, F.lit(0.0).alias("score"))


def _filled(index: SearchIndex, batch: _QueryBatch, scores: DataFrame, k: int, negative: bool) -> DataFrame:
    """The k best of each query, documents with score 0.0 included."""
    id_col = index.id_col
    # Only k rows per task and query leave their bucket.
    best = top_n(scores, ["query_id"], _ordered(id_col), k, slice_by=[id_col]).drop("rank")
    if negative:
        return _top_k(best.unionByName(_unmatched_rows(index, batch, scores, k)), id_col, k)
    # Zeros can only follow when fewer than k match, and then all matches are in the first ranking.
    both = best.unionByName(_zero_rows(index, batch, k))
    return _top_k(both.groupBy("query_id", id_col).agg(F.max("score").alias("score")), id_col, k)


def _hits(index: SearchIndex, batch: _QueryBatch, weights: DataFrame, norms: bool = False) -> DataFrame:
    """Postings of the queries' words with ``weights`` (query_id, term, ...); other folders are not read.

    Norms that an index keeps apart are joined to these postings alone.
    """
    wanted = batch.vocabulary.select(part_of("term", index.parts).alias("part")).distinct().collect()  # at most index.parts
    postings = index.apart[0] if index.apart else index.postings
    hits = join_terms(postings.filter(F.col("part").isin([r["part"] for r in wanted])), weights, batch.small)
    return hits.join(index.apart[1], index.id_col) if index.apart and norms else hits


def _matches_only(scores: DataFrame) -> DataFrame:
    return scores.filter(F.round("score", SCORE_DIGITS) > 0)


def bm25_search(
    index: SearchIndex,
    queries: Queries,
    k: int = TOP_K,
    fill_zero: bool = True,
    k1: float = K1,
    b: float = B,
    epsilon: float = EPSILON,
) -> DataFrame:
    """(query_id, rank, doc, score): the k best documents of each query by BM25.

    Reads the postings of the queries' words for all queries at once, scores
    each document where its bucket is read, and shuffles k rows per task and
    query. Repeated query words count repeatedly.
    """
    id_col = index.id_col
    batch = _QueryBatch(index, queries)
    idf = _looked_up(bm25_idf(index, epsilon), batch)
    weights = batch.terms.join(idf, "term").select("query_id", "term", (F.col("n") * F.col("idf")).alias("_weight"))
    tf, length = F.col("tf"), F.col("length")
    damped = tf + F.lit(float(k1)) * (F.lit(1.0 - b) + F.lit(float(b)) * length / index.average_length)
    score = F.sum(F.col("_weight") * tf * (k1 + 1) / damped)
    scores = _hits(index, batch, weights).groupBy("query_id", id_col).agg(score.alias("score"))
    if fill_zero:
        return _filled(index, batch, scores, k, negative=index.mean_idf < 0)
    return _top_k(_matches_only(scores), id_col, k)


def tfidf_search(index: SearchIndex, queries: Queries, k: int = TOP_K, fill_zero: bool = True) -> DataFrame:
    """(query_id, rank, doc, score): the k best documents of each query by cosine of TF-IDF vectors.

    Read, scored and trimmed as in ``bm25_search``, with the vocabulary the
    index was fitted with. Fails on an empty vocabulary.
    """
    if not index.n_vocabulary:
        raise ValueError("no terms remain after stop words and document-frequency pruning")
    id_col = index.id_col
    batch = _QueryBatch(index, queries)
    idf = smoothed_idf(index, **index.options).select("term", "idf")
    raw = batch.terms.join(_looked_up(idf, batch), "term").withColumn("_w", F.col("n") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("query_id")))
    vectors = raw.select("query_id", "term", (F.col("_w") / norm * F.col("idf")).alias("_weight"))
    score = F.sum(F.col("tf") * F.col("_weight") / F.col("norm"))
    scores = _hits(index, batch, vectors, norms=True).groupBy("query_id", id_col).agg(score.alias("score"))
    if fill_zero:
        return _filled(index, batch, scores, k, negative=False)
    return _top_k(_matches_only(scores), id_col, k)


RANKERS = {"tfidf": tfidf_search, "bm25": bm25_search}


def rank_all(index: SearchIndex, queries: Queries, k: int = TOP_K) -> DataFrame:
    """Both rankers for all queries: (ranker, query_id, rank, doc, score)."""
    tables = [search(index, queries, k).withColumn("ranker", F.lit(name)) for name, search in RANKERS.items()]
    return tables[0].unionByName(tables[1])
