"""Packing by lexical retrieval: each window is filled with the seed document's unused BM25 neighbours."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .byte_tokens import byte_tokenizer, text_encoder
from .common import ship

CAPACITY, END_ID = 1024, 0
K1, B = 1.5, 0.75
TERMS, NEAREST = 16, 32  # terms of a query, and neighbours looked at for one that fits whole
SHARD_TOKENS, PART_TOKENS = 4 << 20, 8 << 20
BATCH_IDS, BATCH_ROWS = 2 << 20, 20_000


def passages(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids_crc32, first, second, ids): every whole text's ids and ``end_id``, cut every ``capacity``.

    ``first`` and ``second`` are the highest ids of a passage that does not fill
    a window: byte-pair merges are learned in order of frequency, so these are
    its rarest tokens, and passages that share them are dealt together. No row
    holds more than a window, however long its text is.
    """
    id_type = docs.schema[id_col].dataType
    names = ("doc_id", "doc_tokens", "start", "length", "ids_crc32", "first", "second", "ids")

    def cut(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        encoder = text_encoder(tokenizer)
        kind = _kind(max(encoder.size, end_id + 1))
        types = (to_arrow_type(id_type), *[pa.int64()] * 4, pa.int32(), pa.int32(), pa.binary())
        out, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=list(names))

        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                own = np.append(encoder.ids(text.as_py()), np.uint32(end_id))
                for start in range(0, len(own), capacity):
                    part, first, second = own[start : start + capacity], 0, 0
                    if len(part) < capacity:
                        first = int(part.max())
                        second = int(part.max(initial=0, where=part != first))
                    out.append((doc_id, len(own), start, len(part), zlib.crc32(part.astype("<u4").tobytes()), first, second, part.astype(kind).tobytes()))
                    size += len(part)
                    if size >= BATCH_IDS:
                        yield batch()
                        out, size = [], 0
        if out:
            yield batch()

    schema = f"doc_id {id_type.simpleString()}, doc_tokens long, start long, length long, ids_crc32 long, first int, second int, ids binary"
    return ship(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def _kind(ids: int) -> str:
    return "<u2" if ids <= 1 << 16 else "<u4"


def passage_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """In how many passages each token id occurs: ``size`` numbers, one partial sum per id and task."""
    kind = _kind(size)

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total[np.unique(np.frombuffer(value.as_buffer(), kind))] += 1
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for row in rows.select("ids").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row.term] = row.n
    return out


class Shard:
    """An inverted index over some passages' token ids, with BM25 weights of the whole corpus."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, average: float):
        found = [np.unique(x, return_counts=True) for x in ids]
        sizes = np.array([len(terms) for terms, _ in found])
        terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        times = np.concatenate([n for _, n in found]).astype(np.float32)
        length = np.repeat(np.array([len(x) for x in ids], np.float32), sizes)
        weights = idf[terms] * times * np.float32(K1 + 1) / (times + np.float32(K1) * (np.float32(1 - B) + np.float32(B) * length / np.float32(average)))
        order = np.argsort(terms, kind="stable")
        self._docs, self._weights = np.repeat(np.arange(len(ids)), sizes)[order], weights[order].astype(np.float64)
        self._starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(idf)))])
        self._own, self._own_weights, self._cuts = terms, weights, np.concatenate([[0], np.cumsum(sizes)])
        self._size = len(ids)

    def query(self, doc: int, most: int) -> np.ndarray:
        """The document's ``most`` heaviest terms, ties to the smaller id."""
        here = slice(self._cuts[doc], self._cuts[doc + 1])
        return self._own[here][np.argsort(-self._own_weights[here], kind="stable")[:most]]

    def neighbours(self, doc: int, used: np.ndarray, terms: int = TERMS, nearest: int = NEAREST) -> list[int]:
        """Unused documents that share a query term, best BM25 score first, ties to the earlier."""
        spans = [slice(self._starts[t], self._starts[t + 1]) for t in self.query(doc, terms)]
        scores = np.bincount(
            np.concatenate([self._docs[s] for s in spans]), np.concatenate([self._weights[s] for s in spans]), minlength=self._size
        )
        scores[used] = 0
        found = np.nonzero(scores)[0]
        if len(found) > 4 * nearest:
            least = np.partition(scores[found], len(found) - nearest)[len(found) - nearest]
            found = found[scores[found] >= least]
        return found[np.argsort(-scores[found], kind="stable")[:nearest]].tolist()


def fill_windows(lengths: list[int], neighbours, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); all but the last ones are full.

    A seed's ids fill one window after the other; the room left in its last one
    goes to its unused neighbours, best first: those that fit whole, then the
    best of the others, cut, whose rest is the next seed. Where no neighbour is
    left, the next unused document follows. What remains at the end is cut at
    powers of two, which need no padding.
    """
    used, windows, window, room = np.zeros(len(lengths), bool), [], [], capacity
    at, seed, start = 0, None, 0

    def put(doc: int, begin: int, length: int) -> None:
        nonlocal window, room
        window.append((doc, begin, length))
        room -= length
        if not room:
            windows.append(window)
            window, room = [], capacity

    while True:
        if seed is None:
            while at < len(lengths) and used[at]:
                at += 1
            if at == len(lengths):
                break
            seed, start = at, 0
            used[seed] = True
        while start < lengths[seed]:
            length = min(room, lengths[seed] - start)
            put(seed, start, length)
            start += length
        last, seed = seed, None
        if room == capacity:
            continue
        near = neighbours(last, used)
        for doc in near:
            if lengths[doc] <= room:
                used[doc] = True
                put(doc, 0, lengths[doc])
                if room == capacity:
                    break
        if room == capacity:
            continue
        seed = next((doc for doc in near if not used[doc]), None)
        if seed is not None:
            used[seed], start = True, 0
    return windows + powers_of_two(window)


def powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window's pieces cut into windows whose lengths are its length's powers of two, largest first."""
    left, out, pieces = sum(n for _, _, n in window), [], list(window)[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left, own = left - room, []
        while room:
            doc, start, length = pieces.pop()
            taken = min(room, length)
            own.append((doc, start, taken))
            if taken < length:
                pieces.append((doc, start + taken, length - taken))
            room -= taken
        out.append(own)
    return out


def _shards(batches, kind: str, shard_tokens: int) -> Iterator[list[tuple]]:
    """(doc_id, start, doc_tokens, ids) of neighbouring rows in lists of about ``shard_tokens`` ids."""
    held, size = [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        for *row, value in zip(*columns, batch.column("ids")):
            ids = np.frombuffer(value.as_py(), kind)
            held.append((*row, ids))
            size += len(ids)
            if size >= shard_tokens:
                yield held
                held, size = [], 0
    if held:
        yield held


def pack_by_retrieval(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    shard_tokens: int = SHARD_TOKENS,
    part_tokens: int = PART_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` if asked for.

    Texts are encoded once and written in passages of at most a window. Those
    that fill their window are sequences already. The others (short documents
    and what is left of longer ones) are sorted into ranges by their rarest
    tokens; each task cuts its range into shards of about ``shard_tokens`` ids,
    indexes a shard and fills its windows with the seeds' neighbours. Token ids
    are the terms, so the corpus-wide passage frequencies are one number per id
    of the vocabulary. Each shard ends in a few sequences of a power of two, all
    others hold ``capacity`` ids: nothing is padded. Repeated rows are dealt by
    row, so no range outgrows its task.

    NULL and empty texts are the end id alone; repeated rows and NULL ids are
    packed as often as they occur; an empty table gives no rows; other columns
    are not read.
    """
    tokenizer = tokenizer or byte_tokenizer()
    size = max(text_encoder(tokenizer).size, end_id + 1)
    kind = _kind(size)
    # By a hash of the rarest token: long texts have the rarest ones and would meet in the last ranges.
    deal = {"_deal": F.xxhash64("first"), "_row": F.monotonically_increasing_id()}
    rows = store(passages(docs, id_col, text_col, tokenizer, end_id, capacity).withColumns(deal))
    open_tokens = F.sum(F.when(F.col("length") < capacity, F.col("length")))
    total = rows.agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.coalesce(open_tokens, F.lit(0)).alias("open")).first()
    frequency = passage_frequencies(rows, size)
    idf = np.log1p((total.n - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    average = (total.tokens or 1) / max(1, total.n)
    id_type = docs.schema[id_col].dataType
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]

    def pack(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(id_type), *[pa.int64()] * 6, *([pa.binary()] if with_ids else [])]
        sequence, out = (1 << 62) + (TaskContext.get().partitionId() << 40), []  # beyond the numbers of rows

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for held in _shards(batches, kind, shard_tokens):
            shard = Shard([ids for *_, ids in held], idf, average)
            for window in fill_windows([len(ids) for *_, ids in held], shard.neighbours, capacity):
                offset = 0
                for passage, begin, length in window:
                    doc_id, start, tokens, ids = held[passage]
                    data = ids[begin : begin + length].astype("<u4").tobytes()
                    out.append((doc_id, start + begin, length, zlib.crc32(data), tokens, sequence, offset, *([data] if with_ids else [])))
                    offset += length
                sequence += 1
                if len(out) >= BATCH_ROWS:
                    yield batch()
                    out = []
        if out:
            yield batch()

    parts = max(1, -(-total.open // part_tokens))
    key = ("_deal", "second", "_row")
    unfilled = ship(rows).where(F.col("length") < capacity).select("doc_id", "start", "doc_tokens", "ids", *key)
    ranged = unfilled.repartitionByRange(parts, *key).sortWithinPartitions(*key).drop(*key)
    schema = f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = ranged.mapInArrow(pack, schema + (", ids binary" if with_ids else ""))
    full = rows.where(F.col("length") == capacity).withColumns({"sequence_id": F.col("_row"), "offset": F.lit(0).cast("long")})
    if with_ids and kind == "<u2":
        full = full.withColumn("ids", F.arrow_udf(_widened, "binary")("ids"))
    return full.select(*names).unionByName(packed)


def _widened(ids: pa.Array) -> pa.Array:
    """16-bit ids as 32-bit ones."""
    return pa.array([np.frombuffer(v.as_buffer(), "<u2").astype("<u4").tobytes() for v in ids], pa.binary())
