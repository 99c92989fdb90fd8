"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import math
from functools import lru_cache, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import is_small, store
from .common import filled, lower_ascii, packed, words_of

WINDOW, SHARE = 13, 0.8
MOST_MASKS = 4  # masks of a family; the heaviest that so few of can find every allowed substitution
PLACES = "array<struct<at:int,seed:bigint>>"
# Rows of seeds and of hits that are broadcast (under 20 MB each); more are joined by a shuffle, which gives the same rows.
SEED_BOUND, HIT_BOUND = 200_000, 200_000


def allowed(size: int, share: float = SHARE) -> int:
    """Substitutions that ``size`` compared words may hold."""
    return size - math.ceil(size * share)


def _cover(size: int, ignored: int, weight: int) -> tuple[str, ...]:
    """Masks of ``weight`` equal places chosen one by one, each for the most patterns of ``ignored`` places not yet found; () if they cannot find all."""
    patterns = [sum(1 << i for i in places) for places in combinations(range(size), ignored)]
    finds = {}
    for span in range(weight, size + 1):
        inner = combinations(range(1, span - 1), weight - 2) if weight > 1 else [()]
        for mask in (sum(1 << i for i in {0, span - 1, *places}) for places in inner):
            finds[mask] = {k for k, p in enumerate(patterns) if any(not (mask << at) & p for at in range(size - span + 1))}
    left, chosen = set(range(len(patterns))), []
    while left:
        mask = max(finds, key=lambda m: (len(finds[m] & left), -m.bit_length(), -m))
        if not finds[mask] & left:
            return ()
        chosen.append(mask)
        left -= finds[mask]
    return tuple(f"{m:b}"[::-1] for m in chosen)


@lru_cache
def masks_for(size: int, ignored: int, most: int = MOST_MASKS) -> tuple[str, ...]:
    """Fixed masks (1 must be equal, 0 may differ) of which one fits ``size`` words with any ``ignored`` of them substituted.

    Of all families of at most ``most`` masks the one that compares most words,
    so that chance hits are few.
    """
    for weight in range(size - ignored, 0, -1):
        family = _cover(size, ignored, weight)
        if family and (len(family) <= most or weight == 1):
            return family
    raise ValueError(f"no masks for {ignored} of {size} words")


def families(lengths: list[int], window: int = WINDOW, share: float = SHARE, most: int = MOST_MASKS) -> dict[tuple[int, ...], tuple[str, ...]]:
    """Masks by the item lengths (up to ``window``, which stands for all longer ones) they serve.

    Lengths that allow equally many substitutions share the masks of the
    shortest of them; items that allow none are looked up whole.
    """
    groups: dict = {}
    for n in sorted(lengths):
        groups.setdefault((allowed(n, share), n if not allowed(n, share) else 0), []).append(n)
    return {tuple(ns): masks_for(ns[0], ignored, most) if ignored else ("1" * ns[0],) for (ignored, _), ns in groups.items()}


def words_column(text: Column) -> Column:
    return words_of(lower_ascii(text))


def seed(hashes: Column, at: Column, mask: str) -> Column:
    """One hash of the words that the mask compares at a place, and of the mask."""
    return F.xxhash64(F.lit(mask), *(F.get(hashes, at + i) for i, c in enumerate(mask) if c == "1"))


def seeds(hashes: Column, length: Column, masks: tuple[str, ...]) -> Column:
    """Array of (position, seed) for every position and mask."""

    def of(mask: str) -> Column:
        each = F.transform(F.sequence(F.lit(0), length - len(mask)), lambda i: F.struct(i.alias("at"), seed(hashes, i, mask).alias("seed")))
        return F.when(length >= len(mask), each).otherwise(F.array().cast(PLACES))

    return F.concat(*map(of, masks))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def found_by(side: DataFrame, bound: int) -> DataFrame:
    """A stored table, to be broadcast if it has at most ``bound`` rows; else joins shuffle."""
    return F.broadcast(side) if is_small(side, bound) else side


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
    most_masks: int = MOST_MASKS,
) -> DataFrame:
    """(doc_id, item_id, start, matched, compared) of every document that holds a benchmark passage.

    A passage is some ``window`` consecutive words of the item (the whole item
    if shorter) with at least ``share`` of them in place; the others may be any
    words. Every item length has masks that fit its words whichever of them are
    substituted, so no passage is lost. Seeds of the documents are joined to the
    benchmark's, and every hit's diagonal is verified word by word. ``matched``
    is the best count of words in place, ``start`` the word of the document where
    the item would begin. Items or documents without words never match; NULL
    texts are empty; rows that repeat a document are reported as often, a
    repeated item counts once; an empty table on either side gives no rows;
    other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.md5(filled(text_col).cast("binary")).alias("_key"), filled(text_col).alias("_text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), words_column(filled(item_text_col)).alias("_item"))
    items = items.where(F.size("_item") > 0).withColumn("_own", word_hashes(F.col("_item")))
    size = F.least(F.size("_item"), F.lit(window))
    lengths = [r["n"] for r in items.select(size.alias("n")).distinct().collect()]  # at most ``window`` numbers
    known = families(lengths, window, share, most_masks)
    parts = [
        items.where(size.isin(list(served))).select("item_id", F.explode(seeds(F.col("_own"), F.size("_item"), masks)).alias("s"))
        for served, masks in known.items()
    ]
    none = items.select("item_id", F.explode(F.array().cast(PLACES)).alias("s"))
    item_seeds = reduce(DataFrame.unionByName, parts, none).select("item_id", F.col("s.at").alias("_item_at"), F.col("s.seed").alias("_seed"))
    table = store(item_seeds.distinct())
    every = sorted({mask for masks in known.values() for mask in masks}) or ["1" * window]

    # Words are hashed in their text's row, places are listed from it, and each place's seeds are computed in generated
    # code. Outer, as ``explode`` would add filters that compute its input once more; NULL seeds join nothing.
    words = words_column(F.col("_text"))
    rows = texts.select("_key", word_hashes(words).alias("_hashes"))
    last = F.size("_hashes") - min(map(len, every))
    listed = rows.select("_key", "_hashes", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("_at"))
    fits = lambda mask: F.col("_at") + len(mask) <= F.size("_hashes")
    each = F.array(*(F.when(fits(mask), seed(F.col("_hashes"), F.col("_at"), mask)) for mask in every))
    places = listed.select("_key", "_at", F.explode_outer(each).alias("_seed"))
    side = found_by(table, SEED_BOUND)
    hits = store(places.join(side, "_seed").select("_key", "item_id", (F.col("_at") - F.col("_item_at")).alias("start")).distinct())

    # The texts with hits come back with their words and are compared along each diagonal.
    few = is_small(hits, HIT_BOUND)
    hit_keys = hits.select("_key").distinct()
    candidates = texts.join(F.broadcast(hit_keys) if few else hit_keys, "_key", "left_semi").dropDuplicates(["_key"]).select("_key", words.alias("_words"))
    compared = hits.join(candidates, "_key").join(items.select("item_id", "_item").distinct(), "item_id")
    equal = F.transform("_item", lambda w, i: F.coalesce(F.get("_words", i + F.col("start")) == w, F.lit(False)).cast("int"))
    compared = compared.select("_key", "item_id", "start", equal.alias("_equal"), F.least(F.lit(window), F.size("_item")).alias("_size"))
    sums = F.transform(
        F.sequence(F.lit(1), F.size("_equal") - F.col("_size") + 1),
        lambda i: F.aggregate(F.slice("_equal", i, F.col("_size")), F.lit(0), lambda a, x: a + x),
    )
    verified = (
        compared.select("_key", "item_id", "start", F.array_max(sums).alias("matched"), F.col("_size").alias("compared"))
        .where(F.col("matched") >= F.ceil(F.col("compared") * F.lit(share)))
        .groupBy("_key", "item_id")
        .agg(F.max(F.struct("matched", (-F.col("start")).alias("back"), "compared")).alias("b"))
        .select("_key", "item_id", (-F.col("b.back")).alias("start"), "b.matched", "b.compared")
    )
    return texts.select("doc_id", "_key").join(F.broadcast(verified) if few else verified, "_key").select("doc_id", "item_id", "start", "matched", "compared")


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold a benchmark passage; all columns kept, clean rows untouched."""
    key = F.md5(filled(text_col).cast("binary"))
    bad = contaminated(docs.select(key.alias("_key"), F.col(text_col).alias("_content")), benchmark, "_key", "_content", **options)
    bad = store(bad.select(F.col("doc_id").alias("_key")).distinct())
    return docs.select(packed(docs), key.alias("_key")).join(found_by(bad, HIT_BOUND), "_key", "left_anti").select("_row.*")
