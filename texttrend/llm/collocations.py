"""Phrase collocations, counted inside the distinct chunks of a prefix-free parse."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.topn import top_n
from ..session import store
from .common import ship

LONGEST, LEAST, SHARE, KEPT = 3, 10, 50, 2000
MODULUS = 48  # one window in so many ends a chunk
# A map of 2 ** PRUNING_BITS bits (16 MB, whatever the corpus) tells tasks which shorter phrases are frequent.
PRUNING_BITS = 27
UNKNOWN, BREAK = "und", b"\n"

_PIECES = re.compile(rb"[.,;:!?\n-\r]+").sub
_WORDS = re.compile(rb"[^ \t]+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)
PARSE_BYTES, COUNT_BYTES = 16 << 20, 7 << 20


# --- parsing ---------------------------------------------------------------------------------------


class _Hashes(dict):
    """Words to 64-bit hashes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _folded(total: np.ndarray, following: np.ndarray) -> np.ndarray:
    total = (total ^ following) * _MIX
    return total ^ (total >> np.uint64(31))


def chunks(text: str | None, overlap: int, modulus: int, hashes: dict) -> list[bytes]:
    """A text cut where its own words say so: tokens joined by a space, BREAK between pieces.

    A window of ``overlap`` tokens whose hash is divisible by ``modulus`` ends a
    chunk and begins the next one, so equal passages give equal chunks wherever
    they stand. The text is led by ``overlap`` breaks: each token lies behind the
    first ``overlap`` tokens of exactly one chunk, with the tokens before it.
    """
    tokens = _WORDS(_PIECES(b" \n ", text.encode("utf-8").lower())) if text else []
    if not tokens:
        return []
    tokens = [BREAK] * overlap + tokens
    each = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    window = np.zeros(len(tokens) - overlap + 1, np.uint64)
    for i in range(overlap):
        window = _folded(window, each[i : i + len(window)])
    window %= np.uint64(modulus)
    ends = np.nonzero(window[1:] == 0)[0] + overlap + 1  # tokens up to and with the window
    ends = ends[ends < len(tokens)].tolist()
    starts = [0, *(e - overlap for e in ends)]
    place = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1).tolist()
    joined = b" ".join(tokens)
    return [joined[place[a - 1] if a else 0 : place[b - 1] - 1] for a, b in zip(starts, [*ends, len(tokens)])]


def parse(docs: DataFrame, text_col: str = "text", group_col: str = "lang", overlap: int = LONGEST - 1, modulus: int = MODULUS) -> DataFrame:
    """(lang, chunk, parses): the distinct chunks of all texts and how often each was parsed.

    Tasks add up their own chunks before the shuffle, so a passage in many
    documents is one row per task.
    """

    def cut(batches):
        hashes, found, size = _Hashes(), Counter(), 0

        def batch():
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["lang", "chunk", "parses"],
            )

        for rows in batches:
            for lang, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                own = chunks(text.as_py(), overlap, modulus, hashes)
                found.update((lang, c) for c in own)
                size += sum(map(len, own)) + 100 * len(own)
                if size >= PARSE_BYTES:
                    yield batch()
                    found, size = Counter(), 0
        if found:
            yield batch()

    lang = F.coalesce(F.col(group_col).cast("string"), F.lit(UNKNOWN)).alias("lang")
    parsed = ship(docs).select(lang, F.col(text_col).alias("text")).mapInArrow(cut, "lang string, chunk string, parses long")
    return parsed.groupBy("lang", "chunk").agg(F.sum("parses").alias("parses"))


# --- counting inside chunks ------------------------------------------------------------------------


class Dictionary:
    """Some distinct chunks as arrays of word numbers."""

    def __init__(self, rows: pa.Table, overlap: int):
        split = pc.split_pattern(rows.column("chunk").combine_chunks(), " ")
        split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
        words = split.flatten().dictionary_encode()
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        lengths = np.diff(split.offsets.to_numpy())
        self.words, self.langs = words.dictionary, langs.dictionary
        self.word = words.indices.to_numpy()  # 32 bits wide, as all that follows
        self.lang = np.repeat(langs.indices.to_numpy(), lengths)
        self.chunk = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.chunk_parses = rows.column("parses").to_numpy()
        self.place = np.arange(len(self.word), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
        self.solid = np.array(pc.not_equal(self.words, BREAK.decode()).to_numpy(zero_copy_only=False))[self.word]
        self.own = self.solid & (self.place >= overlap)  # behind the overlap: counted here and nowhere else

    def ends(self, n: int) -> np.ndarray:
        """Where an ``n``-gram without a break ends that this chunk counts."""
        at = np.nonzero(self.own)[0]
        for back in range(1, n):
            at = at[(self.place[at] >= back) & self.solid[at - back]]
        return at

    def counts(self, at: np.ndarray, n: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """(language, phrase, occurrences) of the distinct ``n``-grams that end at these places."""
        key = self.lang[at].astype(np.int64)
        for back in range(n - 1, -1, -1):
            key *= len(self.words)
            key += self.word[at - back]
            _, first, key = np.unique(key, return_index=True, return_inverse=True)
        times = np.bincount(key, weights=self.chunk_parses[self.chunk[at]], minlength=len(first)).astype(np.int64)
        spoken = [self.words.take(pa.array(self.word[at[first] - back])) for back in range(n - 1, -1, -1)]
        phrases = pc.binary_join_element_wise(*spoken, " ") if n > 1 else spoken[0]
        return self.langs.take(pa.array(self.lang[at[first]])), phrases, times

    def hashes(self, n: int) -> np.ndarray:
        """The hash of the ``n`` words that end at each place; meaningless where they cross a chunk's beginning."""
        total = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.langs.to_pylist()), np.uint64, len(self.langs))[self.lang]
        each = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.words.to_pylist()), np.uint64, len(self.words))[self.word]
        for back in range(n - 1, -1, -1):
            total = _folded(total, np.concatenate([np.zeros(back, np.uint64), each[: len(each) - back]]))
        return total


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """The same hashes of phrases of one length."""
    total = np.fromiter(map(xxhash.xxh64_intdigest, langs), np.uint64, len(langs))
    for words in zip(*(p.split(" ") for p in phrases)):
        total = _folded(total, np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    return total


def _tables(batches, most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def counted(
    dictionary: DataFrame,
    lengths: tuple[int, ...],
    least: int,
    overlap: int,
    frequent: np.ndarray | None = None,
    bits: int = PRUNING_BITS,
    totals: bool = False,
) -> DataFrame:
    """(lang, phrase, f) of all phrases of these lengths with f >= ``least``.

    An n-gram counts as often as its chunk was parsed, in the one chunk that
    holds its last word behind the overlap. With ``frequent`` (a map of the
    frequent phrases one word shorter) phrases with an infrequent part are left
    out before the shuffle; with ``totals`` the phrase '' counts all words.
    """

    def count(batches):
        for rows in _tables(batches, COUNT_BYTES):
            own = Dictionary(rows, overlap)
            found = []
            if totals:
                words = np.bincount(own.lang[own.own], weights=own.chunk_parses[own.chunk[own.own]], minlength=len(own.langs)).astype(np.int64)
                found.append((own.langs, pa.array([""] * len(own.langs)), words))
            for n in lengths:
                at = own.ends(n)
                if frequent is not None:
                    known = has_bit(frequent, own.hashes(n - 1), bits)
                    at = at[known[at] & known[at - 1]]
                if len(at):
                    found.append(own.counts(at, n))
            for langs, phrases, times in found:
                yield from pa.Table.from_arrays([langs, phrases, pa.array(times)], names=["lang", "phrase", "f"]).to_batches(max_chunksize=100_000)

    partial = ship(dictionary).mapInArrow(count, "lang string, phrase string, f long")
    return partial.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))


def frequent_bits(table: DataFrame, bits: int = PRUNING_BITS) -> np.ndarray:
    """A map with the bit of every phrase of a stored table set, found by its hash.

    Its size is fixed: the more phrases a corpus has, the more infrequent ones
    share a bit with a frequent one and are counted on, to be left out by their
    exact count. None that is frequent is ever left out.
    """

    def hashed(langs: pa.Array, phrases: pa.Array) -> pa.Array:
        return pa.array((phrase_hashes(langs.to_pylist(), phrases.to_pylist()) & np.uint64((1 << bits) - 1)).astype(np.int64))

    bit = F.arrow_udf(hashed, "long")("lang", "phrase").alias("_bit")
    words = ship(table).select(bit).select(F.shiftright("_bit", 6).alias("at"), F.expr("shiftleft(1L, CAST(_bit & 63 AS INT))").alias("mask"))
    found = words.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(max(1, 1 << bits >> 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return out


def has_bit(frequent: np.ndarray, hashes: np.ndarray, bits: int = PRUNING_BITS) -> np.ndarray:
    bit = hashes & np.uint64((1 << bits) - 1)
    return (frequent[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


# --- scores ----------------------------------------------------------------------------------------


def association(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: a below 10**15, the others any long."""
    a, left, right = a.cast("decimal(15,0)"), left.cast("decimal(19,0)"), right.cast("decimal(19,0)")
    above, below = F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right
    return F.call_function("div", above, below)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    group_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    kept: int = KEPT,
    modulus: int = MODULUS,
    pruning_bits: int = PRUNING_BITS,
) -> DataFrame:
    """The first ``kept`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are parsed into chunks once, and n-grams are counted in the distinct
    chunks alone: words and pairs in one pass, each greater length in another
    that leaves out phrases with an infrequent part. A phrase's score is that of
    its weakest cut into two; a phrase inside a longer candidate that makes up
    ``share`` percent of it is dropped.

    NULL and blank texts hold no words; a NULL language counts as 'und'; repeated
    rows count as often as they occur; an empty table gives no rows; other
    columns are not read.
    """
    overlap = max(1, longest - 1)
    dictionary = store(parse(docs, text_col, group_col, overlap, modulus))
    first = store(counted(dictionary, tuple(range(1, min(2, longest) + 1)), least, overlap, totals=True))
    words = lambda c: F.size(F.split(c, " "))
    levels, last = [first.where("phrase != ''")], first.where((F.col("phrase") != "") & (words("phrase") == 2))
    for n in range(3, longest + 1):
        last = store(counted(dictionary, (n,), least, overlap, frequent_bits(last, pruning_bits), pruning_bits))
        levels.append(last)
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)

    parts = F.split("phrase", " ")
    candidates = counts.where(words("phrase") >= 2).select("lang", "phrase", F.col("f").alias("a"), parts.alias("_words"))
    joined = lambda start, size: F.array_join(F.slice("_words", start, size), " ")
    cuts = candidates.select("lang", "phrase", "a", "_words", F.explode(F.sequence(F.lit(1), F.size("_words") - 1)).alias("_k"))
    cuts = cuts.select("lang", "phrase", "a", "_k", joined(F.lit(1), F.col("_k")).alias("_left"), joined(F.col("_k") + 1, F.size("_words") - F.col("_k")).alias("_right"))
    for side, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    weakest = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(association(F.col("a"), F.col("l"), F.col("r")).alias("score"), "_k", "l", "r")).alias("c")
    )
    scores = weakest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    if longest > 2:
        inner = F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.size("_words") - 1),
                lambda size: F.transform(F.sequence(F.lit(1), F.size("_words") - size + 1), lambda start: F.array_join(F.slice("_words", start, size), " ")),
            )
        )
        longer = candidates.where(F.size("_words") > 2).select("lang", "a", F.explode(inner).alias("phrase"))
        longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
        scores = scores.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a"))).drop("_longer")
    best = top_n(scores, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], kept, slice_by=["phrase"])
    totals = first.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces),
spoken AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3]) AS size)),
counts AS (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM spoken GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1 AND f >= 10),
cuts AS (SELECT lang, size, phrase, a, ws, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, l.f AS l, r.f AS r, ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, a FROM candidates WHERE size = 3),
longer AS (SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL),
left_over AS (
  SELECT w.* FROM weakest w LEFT JOIN longer o ON o.lang = w.lang AND o.phrase = w.phrase WHERE o.a IS NULL OR 100 * o.a < 50 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM left_over JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
