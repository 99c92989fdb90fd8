"""Importance resampling towards a target distribution, with n-gram hashes read off prefix CRCs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_table, store
from .common import packed, rows_of, ship

# The reversed CRC-32 polynomial; bytes that belong to words (the rest separates them).
POLYNOMIAL = 0xEDB88320
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LONGEST, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024
BATCH_BYTES = 2 << 20

# Every byte as it stands in a normalised document: letters in lower case, separators as spaces.
_NORMAL = bytes(b + 32 if b in _UPPER else b if b in _WORD or b > 0x7F else 0x20 for b in range(256))
_PARTS = re.compile(rb" [^ ]+").findall


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _apply(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map over GF(2), given as what it makes of each value of each of the four bytes."""
    return tables[0][values & 255] ^ tables[1][(values >> 8) & 255] ^ tables[2][(values >> 16) & 255] ^ tables[3][values >> 24]


def _shift_tables(most: int = 32) -> list[np.ndarray]:
    """Maps that carry a CRC over 1, 2, 4, 8, ... zero bytes."""
    values = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    maps = [BYTES[values & 255] ^ (values >> 8)]
    while len(maps) < most:
        maps.append(_apply(maps[-1], maps[-1]))
    return maps


BYTES = _byte_table()
SHIFTS = _shift_tables()


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC carried over that many zero bytes: multiplied by a power of x modulo the polynomial."""
    out = crcs.copy()
    for bit in range(int(lengths.max(initial=0)).bit_length()):
        on = np.nonzero((lengths >> bit) & 1)[0]
        out[on] = _apply(SHIFTS[bit], out[on])
    return out


def _after_space(crcs: np.ndarray) -> np.ndarray:
    inner = crcs ^ np.uint32(0xFFFFFFFF)
    return BYTES[(inner ^ 0x20) & 255] ^ (inner >> 8) ^ np.uint32(0xFFFFFFFF)


class Prefixes:
    """Running CRCs of some normalised documents, in which one space leads every word.

    Documents are read once. ``marks`` holds, for each document, the CRC of
    nothing and then the CRC up to the end of each word; ``ends`` the bytes that
    lie before these places.
    """

    def __init__(self, texts: list):
        marks, sizes, words = [], [], []
        for text in texts:
            parts = _PARTS(b" " + text.encode("utf-8").translate(_NORMAL)) if text else []
            marks.extend(accumulate(parts, lambda crc, part: zlib.crc32(part, crc), initial=0))
            sizes.append(0)
            sizes.extend(map(len, parts))
            words.append(len(parts))
        self.marks = np.array(marks, np.uint32)
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.words = np.array(words, np.int64)
        first = np.cumsum(self.words + 1) - self.words - 1
        self._place = np.arange(len(marks)) - np.repeat(first, self.words + 1)  # 0 where no word ends

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """CRCs of all runs of ``n`` words, joined by one space, and the places where they end.

        The CRC of a run follows from the two prefixes around it: the shorter one,
        carried over the run's length, cancels out of the longer one.
        """
        at = np.nonzero(self._place >= n)[0]
        lengths = self.ends[at] - self.ends[at - n] - 1
        return self.marks[at] ^ shifted(_after_space(self.marks[at - n]), lengths), at

    def features(self, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """CRCs of all runs of 1 to ``longest`` words, document by document, and their number in each."""
        found = [self.grams(n) for n in range(1, longest + 1)]
        counts = sum(np.maximum(self.words - n + 1, 0) for n in range(1, longest + 1))
        if longest == 1:
            return found[0][0], counts
        order = np.argsort(np.concatenate([at for _, at in found]), kind="stable")
        return np.concatenate([crcs for crcs, _ in found])[order], counts


def _groups(rows: Iterator[tuple], most: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Rows (key, text) in lists of about ``most`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1] or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def hashed_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): the bucket of every feature of every whole text, packed."""
    id_type = docs.schema[id_col].dataType
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def scan(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        for rows in _groups(rows_of(batches, id_col, text_col)):
            prefixes = Prefixes([text for _, text in rows])
            crcs, counts = prefixes.features(longest)
            data = (crcs % np.uint32(buckets)).astype(kind).tobytes()
            cuts = np.concatenate([[0], np.cumsum(counts)]) * int(kind[-1])
            values = [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], to_arrow_type(id_type)), pa.array(prefixes.words), pa.array(counts), pa.array(values, pa.binary())],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

    schema = f"doc_id {id_type.simpleString()}, n_words long, n_features long, buckets binary"
    return ship(docs).select(id_col, text_col).mapInArrow(scan, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all documents: ``buckets`` numbers, whatever the size of the table.

    Every task adds up its own documents and sends at most one row per bucket.
    """
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets) if len(value.as_buffer()) else 0
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    partial = features.select("buckets").mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier each bucket is in the target; counts smoothed by one."""
    all_source, all_target, many = int(source.sum()), int(target.sum()), len(source)
    each = [
        math.floor(1000 * math.log(float(t + 1) * float(all_source + many) / (float(s + 1) * float(all_target + many))))
        for s, t in zip(source.tolist(), target.tolist())
    ]
    return np.array(each, np.int64)


def gumbel(doc_id, seed: int = SEED) -> int:
    """floor(1000 * a Gumbel number) that a hash of the id names."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: np.ndarray, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, eligible) of every document."""
    kind, id_type = "<u2" if len(gain) <= 1 << 16 else "<u4", features.schema["doc_id"].dataType

    def score(batches):
        for batch in batches:
            ids, n = batch.column("doc_id").to_pylist(), batch.column("n_features").to_pylist()
            weights = [
                int(gain[np.frombuffer(value.as_buffer(), kind)].sum()) // many if many else 0 for value, many in zip(batch.column("buckets"), n)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_features"),
                    pa.array(weights, pa.int64()),
                    pa.array([w + gumbel(i, seed) for w, i in zip(weights, ids)], pa.int64()),
                    pa.array([w >= least_words for w in batch.column("n_words").to_pylist()]),
                ],
                names=["doc_id", "n_features", "weight", "score", "eligible"],
            )

    return features.mapInArrow(score, f"doc_id {id_type.simpleString()}, n_features long, weight long, score long, eligible boolean")


def numbered(rows: DataFrame, *order, name: str = "rank") -> DataFrame:
    """``rows`` numbered from 1 in ``order``, by ranges: no task holds more than its share.

    Rows are sorted by range partitions and written with their partition and
    place; a row's number is its place plus the rows of the partitions before it,
    one number per partition.
    """
    placed = store(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).cast("int")
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy(part.alias("_part")).count().collect())
    before = list(accumulate((n for _, n in sizes), initial=0))
    offsets = small_table(rows.sparkSession, [(p, b) for (p, _), b in zip(sizes, before)], "_part int, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, place).drop("_part", "_before", "_at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``rank`` is NULL for those not drawn.

    Weights compare hashed n-gram counts of all ``docs`` with those of all
    ``target`` texts; adding Gumbel noise named by the id and taking the highest
    scores draws without replacement, in proportion to the weights. ``percent`` of
    the documents with at least ``least_words`` words are drawn, ties to the
    smaller id. Every text is scanned once: its buckets are written (two bytes a
    feature), then counted and weighed from there.

    NULL and blank texts have no features, weight 0, and are never drawn unless
    ``least_words`` is 0; a NULL id counts as '' and comes last among ties;
    repeated rows each count and are each drawn or not; an empty table gives no
    rows, an empty target T = 0; other columns are not read.
    """
    features = store(hashed_features(docs, id_col, text_col, longest, buckets))
    aimed = hashed_features(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")), longest=longest, buckets=buckets)
    rows = scored(features, gains(bucket_counts(features, buckets), bucket_counts(aimed, buckets)), seed, least_words)
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # deals rows that repeat an id to different ranges
    ordered = numbered(rows, F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), "_row")
    draw = features.where(F.col("n_words") >= least_words).count() * percent // 100
    rank = F.when(F.col("eligible") & (F.col("rank") <= draw), F.col("rank"))
    return ordered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, all columns kept; a row without an id never is."""
    chosen = resample(docs, target, id_col, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("_key")).distinct()
    return docs.select(packed(docs), F.col(id_col).alias("_key")).join(chosen, "_key", "left_semi").select("_row.*")


ORACLE_SQL = """
WITH bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda j: 0::UBIGINT)),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS steps),
texts AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
worded AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words, row_number() OVER () AS doc
  FROM texts),
counted AS (
  SELECT side, doc, word, count(*) AS n FROM (SELECT side, doc, unnest(words) AS word FROM worded) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM counted),
bucketed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::UBIGINT)),
    lambda c, b: xor(steps[(xor(c, b) % 256)::INT + 1], c >> 8)), 4294967295::UBIGINT) % 10000 AS bucket
  FROM vocabulary, bytes),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM counted JOIN bucketed USING (word) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS big_s, coalesce(sum(t), 0) AS big_t FROM sums),
gained AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (big_s + 10000) / ((s + 1) * (big_t + 10000))))::BIGINT AS gain FROM sums, totals),
weighed AS (
  SELECT doc, sum(n * gain) AS total, sum(n) AS many
  FROM counted JOIN bucketed USING (word) JOIN gained USING (bucket) WHERE side = 0 GROUP BY doc),
scores AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / many), 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM worded LEFT JOIN weighed USING (doc) WHERE side = 0),
ranked AS (
  SELECT doc_id, n_features, weight, weight + noise AS score,
    row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS eligible
  FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= eligible * 10 // 100 THEN place END AS rank FROM ranked
"""
