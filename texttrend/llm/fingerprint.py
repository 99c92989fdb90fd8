"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, input_bytes, rows_of, ship

# Odd multipliers for mixing 64-bit numbers.
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
WIDTH, BINS, KEPT = 5, 512, 4
CHUNK = 1 << 16
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * STEP
    return x ^ (x >> np.uint64(29))


def bin_minima(text: str | None, width: int = WIDTH, bins: int = BINS) -> np.ndarray | None:
    """The least hash of every bin, EMPTY where a bin has no shingle; None for a text without words.

    Every shingle of ``width`` words (a shorter text is one shingle) is hashed
    once; the upper bits choose the bin, the rest is the value.
    """
    words = byte_words(text)
    if not words:
        return None
    least = np.full(bins, EMPTY)
    shift = np.uint64(64 - (bins - 1).bit_length())
    width = min(width, len(words))
    for start in range(0, len(words) - width + 1, CHUNK):
        some = words[start : start + CHUNK + width - 1]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some), np.uint64, len(some))
        count = len(hashes) - width + 1
        total = np.zeros(count, np.uint64)
        for i in range(width):
            total = _mixed(total * MIX + hashes[i : i + count])
        where = (total >> shift).astype(np.int64)
        np.minimum.at(least, where, total & ((np.uint64(1) << shift) - np.uint64(1)))
    return least


_PROBES: dict[tuple[int, int], np.ndarray] = {}


def _probes(bins: int, first: int) -> np.ndarray:
    """Row by bin: the bins that attempts ``first`` to 8 * ``first`` - 1 name."""
    if (bins, first) not in _PROBES:
        bin_, attempt = np.arange(bins, dtype=np.uint64)[:, None], np.arange(first, 8 * first, dtype=np.uint64)[None, :]
        _PROBES[bins, first] = (_mixed(bin_ * MIX + attempt * STEP) % np.uint64(bins)).astype(np.int16 if bins <= 1 << 15 else np.int64)
    return _PROBES[bins, first]


def densified(least: np.ndarray) -> np.ndarray:
    """Empty bins filled from bins that a hash of (bin, attempt) names, tried until one is full.

    The attempts depend on the bin alone, so equal bins of two texts stay equal,
    and they are tables that one worker makes once.
    """
    full = least != EMPTY
    filled, empty, first = least.copy(), np.nonzero(~full)[0], 1
    while len(empty):
        probes = _probes(len(least), first)[empty]
        hit = full[probes]
        at = hit.argmax(axis=1)
        found = hit[np.arange(len(empty)), at]
        filled[empty[found]] = least[probes[found, at[found]]]
        empty, first = empty[~found], 8 * first
    return filled


def fingerprint(text: str | None, width: int = WIDTH, bins: int = BINS, kept: int = KEPT) -> bytes:
    """The ``kept`` low-order bits of every bin, packed; b'' for a text without words."""
    least = bin_minima(text, width, bins)
    if least is None:
        return b""
    low = (_mixed(densified(least)) & np.uint64((1 << kept) - 1)).astype(np.uint8)
    return np.packbits((low[:, None] >> np.arange(kept, dtype=np.uint8)) & np.uint8(1), bitorder="little").tobytes()


def likeness(a: bytes, b: bytes, bins: int = BINS, kept: int = KEPT) -> float:
    """Estimated Jaccard similarity from 0 to 1, corrected for low-order bits that agree by chance.

    Two texts without words are alike; one without words is like no other.
    """
    if not a or not b:
        return float(a == b)
    differ = np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8), bitorder="little").reshape(bins, kept).any(axis=1)
    chance = 1 / (1 << kept)
    return float(min(1.0, max(0.0, (1 - differ.mean() - chance) / (1 - chance))))


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", width: int = WIDTH, bins: int = BINS, kept: int = KEPT) -> DataFrame:
    """``docs`` with the fingerprint of a text column as binary; NULL and blank texts give an empty one."""

    def printed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), width, bins, kept) for t in texts], pa.binary())

    return ship(docs).withColumn(name, F.arrow_udf(printed, "binary")(F.col(text_col)))


# --- each document beside the next ---------------------------------------------------------------


def ordered_runs(docs: DataFrame, id_col: str, text_col: str, run_bytes: int = 16 << 20) -> DataFrame:
    """Rows (run, doc_id, text, ahead) in which every run of neighbouring ids is followed by the next run's first row.

    Ids are cut into runs at quantiles, so runs hold about ``run_bytes`` of
    text. A run's first row is also dealt to the run before it (the first of all
    to the last), marked ``ahead``; only run numbers and their first ids reach
    the driver. Ids are cast to long; NULL ids come first, equal ids are ordered by text.
    """
    rows = ship(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    runs = max(1, -(-input_bytes(rows, "text") // run_bytes))
    marks = [i / runs for i in range(1, runs)]
    cuts = rows.agg(F.percentile_approx("doc_id", marks, max(10_000, 10 * runs)).alias("c")).first().c if marks else None
    cuts = np.unique(np.array(cuts or [], np.int64))

    def run_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(cuts, known, side="right"), pa.int32())

    placed = rows.withColumn("run", F.arrow_udf(run_of, "int")("doc_id"))
    least = placed.groupBy("run").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("h"))
    first = {r.run: r.h.doc_id for r in least.collect()}
    order = sorted(first)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    known = np.array(sorted(v for v in first.values() if v is not None), np.int64)
    leads_null = None in first.values()

    def leads(ids: pa.Array) -> pa.Array:
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), leads_null, np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), known)))

    def run_before(numbers: pa.Array) -> pa.Array:
        return pa.array([before[n] for n in numbers.to_pylist()], pa.int32())

    heads = (
        placed.where(F.arrow_udf(leads, "boolean")("doc_id"))
        .groupBy("run")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text")).alias("h"))
        .select(F.arrow_udf(run_before, "int")("run").alias("run"), "h.doc_id", "h.text", F.lit(True).alias("ahead"))
    )
    return placed.select("run", "doc_id", "text", F.lit(False).alias("ahead")).unionByName(heads)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the following text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, bins: int = BINS, kept: int = KEPT, run_bytes: int = 16 << 20) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document.

    Rows: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next. Texts are shuffled once, by run; a task reads its
    run in order with one row of look-ahead. NULL texts are empty; the last
    document is followed by the first (a single one by itself); rows with equal
    ids each count as a document; an empty table gives no rows; other columns
    are not read.
    """

    def compare(batches) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def batch():
            names = ("doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
            types = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=list(names))

        held = None
        for run, doc_id, text, ahead in rows_of(batches, "run", "doc_id", "text", "ahead"):
            own = fingerprint(text, width, bins, kept)
            if held is not None and held[0] == run:
                _, held_id, held_text, held_print = held
                changed = edited(held_text, text)
                second = fingerprint(changed, width, bins, kept)
                out.append((held_id, len(held_text), changed, held_print, second, likeness(held_print, second, bins, kept), likeness(held_print, own, bins, kept)))
                size += len(changed)
                if size > 4 << 20:
                    yield batch()
                    out, size = [], 0
            held = None if ahead else (run, doc_id, text, own)
        if out:
            yield batch()

    runs = ordered_runs(docs, id_col, text_col, run_bytes)
    schema = "doc_id long, n_chars long, edited_text string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    return ship(runs).repartition("run").sortWithinPartitions("run", "ahead", "doc_id", "text").mapInArrow(compare, schema)


def digest(compared: DataFrame) -> DataFrame:
    """Fingerprints in hex and the edited text's SHA-256."""
    as_hex = lambda c: F.lower(F.hex(c)).alias(c)
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        as_hex("fingerprint"),
        as_hex("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
