"""Lexicon sentiment as joins between words and a lexicon table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import is_small

NEGATION_FACTOR = -0.5
# Means are rounded, so that a score does not depend on the order of a sum and
# one meant to sit on a label threshold does.
SCORE_DIGITS = 9


def lexicon_scores(
    corpus: DataFrame, lexicon: DataFrame, keep: Sequence[str] = (), text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Polarity of each document: one row of ``id_col``, ``keep`` and ``sentiment``.

    Mean over the polar words of the text. A modifier right before scales the
    word (clipped to [-1, 1]); a negation before it, or before that modifier or
    a one-letter word, turns it by -0.5. Without polar words the score is 0.0.

    Each word takes its two predecessors along from its own row, so neither a
    window nor a sort is needed. A lexicon of checked size is broadcast: words
    meet it where the text is read and are averaged before the only shuffle, of
    one narrow row per document. Pass in ``keep`` the few columns later steps
    need and no join back to the articles is needed. A larger lexicon is
    shuffled by word instead, dropping words without an entry on the way. Either
    way rows are grouped by ``id_col`` and ``keep`` together, so both give the
    same rows, also where ids repeat.
    """
    small = is_small(lexicon)
    sized = F.broadcast if small else (lambda df: df)
    polar = lexicon.filter("kind = 'polar'").select("term", F.col("polarity").alias("_p"))
    context = lexicon.filter("kind <> 'polar'").groupBy("term").agg(
        F.max(F.when(F.col("kind") == "modifier", F.col("intensity"))).alias("_scale"),
        F.max(F.col("kind") == "negation").alias("_neg1"),
    )
    before = context.withColumnRenamed("term", "_w1")
    earlier = context.filter("_neg1").select(F.col("term").alias("_w2"), F.lit(True).alias("_neg2"))

    # A NULL word leads every document, so that one without polar words keeps a row.
    def shifted(by: int):
        return F.concat(F.array(*[F.lit(None).cast("string")] * (by + 1)), F.col("_tokens"))

    triples = F.arrays_zip(shifted(0).alias("term"), shifted(1).alias("_w1"), shifted(2).alias("_w2"))
    words = (
        corpus.select(id_col, *keep, tokenize(text).alias("_tokens"))
        .select(id_col, *keep, F.explode_outer(triples).alias("_w"))
        .select(id_col, *keep, "_w.term", "_w._w1", "_w._w2")
    )
    if small:
        hits = words.join(sized(polar), "term", "left").filter("_p IS NOT NULL OR term IS NULL")
    else:
        # Inner, so that words without an entry are not shuffled on; the leading NULLs come past the join.
        leads = words.filter("term IS NULL").withColumn("_p", F.lit(None).cast("double"))
        hits = words.filter("term IS NOT NULL").join(polar, "term").unionByName(leads)
    scored = hits.join(sized(before), "_w1", "left").join(sized(earlier), "_w2", "left")
    scale, p = F.col("_scale"), F.col("_p")
    # "least" and "greatest" pass over NULLs, so rows without a polarity are kept out of them.
    unscaled = scale.isNull() | p.isNull()
    scaled = F.when(unscaled, p).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), p * scale)))
    skipped = scale.isNotNull() | (F.length("_w1") == 1)
    negated = F.coalesce("_neg1", F.lit(False)) | (F.coalesce(skipped, F.lit(False)) & F.col("_neg2").isNotNull())
    value = F.when(negated, scaled * NEGATION_FACTOR).otherwise(scaled)
    mean = F.coalesce(F.round(F.avg(value), SCORE_DIGITS), F.lit(0.0)).alias("sentiment")
    return scored.groupBy(id_col, *keep).agg(mean)


def annotate_sentiment(corpus: DataFrame, lexicon: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``corpus`` with a ``sentiment`` column; every row is kept.

    Joins whole rows on the document key. Store the corpus bucketed by that key
    to join in place, or use ``lexicon_scores(keep=...)`` where the texts are
    not needed any more.
    """
    scores = lexicon_scores(corpus, lexicon, text=text, id_col=id_col)
    joined = corpus.drop("sentiment").join(scores, id_col, "left")
    return joined.withColumn("sentiment", F.coalesce("sentiment", F.lit(0.0)))


def annotate(
    corpus: DataFrame,
    method: str = "lexicon",
    lexicon: DataFrame | None = None,
    predictor_factory: Callable | None = None,
    text: str = "text",
) -> DataFrame:
    """Score by ``"lexicon"`` (the default) or by ``"model"``."""
    if method == "lexicon":
        if lexicon is None:
            raise ValueError("method 'lexicon' needs a lexicon table")
        return annotate_sentiment(corpus, lexicon, text=text)
    if method == "model":
        if predictor_factory is None:
            raise ValueError("method 'model' needs a predictor factory")
        from .model import annotate_with_model

        return annotate_with_model(corpus, predictor_factory, text=text)
    raise ValueError(f"unknown method {method!r}")
