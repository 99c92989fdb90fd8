"""Token ids in binary files of patched frame-of-reference blocks, written and read by Spark tasks.

A file holds, little-endian: a header (magic, ids, documents, blocks), the block
index, the packed words, the exceptions and the document table. A block is 1,024
ids: its minimum is subtracted, the differences are packed with as many bits as
a percentile of them needs, and what does not fit leaves its upper bits in the
exception list. The index gives every block's start among the packed words and
among the exceptions, so any id is found without reading the blocks before it.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder, store
from .common import input_bytes, rows_of, ship
from .tokens import default_tokenizer, encoder

# Fixed values of the file format.
MAGIC, BLOCK, LANE = b"PFORIDS1", 1024, 64
HEADER = struct.Struct("<8sQQQ")
INDEX = np.dtype([("minimum", "<u4"), ("width", "<u4"), ("words", "<u8"), ("exceptions", "<u8")])
EXCEPTION = np.dtype([("position", "<u2"), ("upper", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("ids", "<u4")])
CHUNK = 1 << 12  # blocks handled at once


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(groups, 64) numbers below 2**width as (groups, width) words."""
    words = np.zeros((len(values), width), np.uint64)
    for lane in range(LANE):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= values[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= values[:, lane] >> np.uint64(64 - shift)
    return words


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    values = np.zeros((len(words), LANE), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for lane in range(LANE if width else 0):
        word, shift = divmod(lane * width, 64)
        part = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            part = part | (words[:, word + 1] << np.uint64(64 - shift))
        values[:, lane] = part & mask
    return values


def encode_blocks(ids: np.ndarray, percentile: float = 95.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, packed words, exceptions) of unsigned 32-bit ids."""
    blocks = -(-len(ids) // BLOCK)
    index, words, exceptions = np.zeros(blocks, INDEX), [], []
    at = found = 0
    for first in range(0, blocks, CHUNK):
        part = ids[first * BLOCK : (first + CHUNK) * BLOCK].astype(np.uint64)
        short = -len(part) % BLOCK
        table = np.concatenate([part, np.full(short, part[-1], np.uint64)]).reshape(-1, BLOCK)
        least = table.min(axis=1)
        table -= least[:, None]
        bound = np.percentile(table, percentile, axis=1, method="higher").astype(np.uint64)
        width = np.array([int(b).bit_length() for b in bound], np.int64)
        here = index[first : first + len(table)]
        here["minimum"], here["width"] = least, width
        size = width * (BLOCK // LANE)
        here["words"] = at + np.cumsum(size) - size
        packed = np.zeros(int(size.sum()), np.uint64)
        upper = table >> width[:, None].astype(np.uint64)
        for w in np.unique(width[width > 0]):
            chosen = np.nonzero(width == w)[0]
            low = (table[chosen] & np.uint64((1 << int(w)) - 1)).reshape(-1, LANE)
            where = (here["words"][chosen].astype(np.int64) - at)[:, None] + np.arange(int(w) * (BLOCK // LANE))
            packed[where] = _pack(low, int(w)).reshape(len(chosen), -1)
        row, position = np.nonzero(upper)
        late = np.zeros(len(row), EXCEPTION)
        late["position"], late["upper"] = position, upper[row, position]
        many = np.bincount(row, minlength=len(table))
        here["exceptions"] = found + np.cumsum(many) - many
        words.append(packed)
        exceptions.append(late)
        at, found = at + len(packed), found + len(late)
    return index, np.concatenate(words or [np.zeros(0, np.uint64)]), np.concatenate(exceptions or [np.zeros(0, EXCEPTION)])


def decode_blocks(index: np.ndarray, words: np.ndarray, exceptions: np.ndarray, first: int, last: int) -> np.ndarray:
    """Ids of blocks ``first`` to ``last`` (exclusive), the padding of a file's last block included."""
    some = index[first:last]
    table = np.zeros((len(some), BLOCK), np.uint64)
    width = some["width"].astype(np.int64)
    for w in np.unique(width[width > 0]):
        chosen = np.nonzero(width == w)[0]
        where = some["words"][chosen].astype(np.int64)[:, None] + np.arange(int(w) * (BLOCK // LANE))
        table[chosen] = _unpack(words[where].reshape(-1, int(w)), int(w)).reshape(-1, BLOCK)
    start = int(some["exceptions"][0]) if len(some) else 0
    end = int(index["exceptions"][last]) if last < len(index) else len(exceptions)
    late = exceptions[start:end]
    if len(late):
        row = np.searchsorted(some["exceptions"].astype(np.int64), np.arange(start, end), side="right") - 1
        table[row, late["position"]] |= late["upper"].astype(np.uint64) << width[row].astype(np.uint64)
    return (table + some["minimum"].astype(np.uint64)[:, None]).astype(np.uint32).reshape(-1)


def file_bytes(ids: np.ndarray, documents: np.ndarray, percentile: float = 95.0) -> bytes:
    index, words, exceptions = encode_blocks(ids, percentile)
    header = HEADER.pack(MAGIC, len(ids), len(documents), len(index)) + struct.pack("<QQ", len(words), len(exceptions))
    return b"".join([header, index.tobytes(), words.tobytes(), exceptions.tobytes(), documents.tobytes()])


class IdFile:
    """One file's contents: documents and any range of ids."""

    def __init__(self, content: bytes):
        magic, self.ids, documents, blocks = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a file of token-id blocks")
        words, exceptions = struct.unpack_from("<QQ", content, HEADER.size)
        at = HEADER.size + 16
        parts = []
        for kind, many in ((INDEX, blocks), (np.dtype("<u8"), words), (EXCEPTION, exceptions), (DOCUMENT, documents)):
            parts.append(np.frombuffer(content, kind, many, at))
            at += kind.itemsize * many
        self._index, self._words, self._exceptions, self.documents = parts

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive); only the blocks that hold them are decoded."""
        first, last = start // BLOCK, -(-end // BLOCK)
        return decode_blocks(self._index, self._words, self._exceptions, first, last)[start - first * BLOCK : end - first * BLOCK]


# --- Spark ---------------------------------------------------------------------------------------


def write_id_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    percentile: float = 95.0,
    text_bytes_per_file: int = 32 << 20,
) -> DataFrame:
    """Write the ids of all documents in ascending id order; return the manifest.

    One file per range of ids, sized by text bytes. A task writes under a name
    of its own, and only files named in the manifest (file_no, name, n_docs,
    n_ids, first_id) count, so tasks may run again. ``folder`` is any place that
    pyarrow can write and Spark can read.
    """
    tokenizer = tokenizer or default_tokenizer()
    work = ship(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    files = max(1, -(-input_bytes(work, "text") // text_bytes_per_file))

    def write(batches):
        from pyarrow import fs

        ids_of, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        ids, rows, number = [], [], TaskContext.get().partitionId()
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            own = ids_of.text_ids(text) + end
            ids.append(own)
            rows.append((doc_id or 0, doc_id is not None, len(own) // 4))
        if not rows:
            return
        flat = np.frombuffer(b"".join(ids), np.uint32)
        del ids
        store_at, path = fs.FileSystem.from_uri(folder)
        name = f"ids-{number:06d}-{uuid.uuid4().hex}.pfor"
        store_at.create_dir(path, recursive=True)
        with store_at.open_output_stream(f"{path}/{name}", compression=None) as out:
            out.write(file_bytes(flat, np.array(rows, DOCUMENT), percentile))
        yield pa.RecordBatch.from_pydict({"file_no": [number], "name": [name], "n_docs": [len(rows)], "n_ids": [len(flat)]})

    manifest = store(
        work.repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "file_no long, name string, n_docs long, n_ids long")
    )
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_id_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document as read from the files: doc_id, start, n_tokens, ids_crc32, and ``ids`` if asked for."""

    def read(batches):
        for path, content in rows_of(batches, "path", "content"):
            file, at, out = IdFile(content), 0, []
            ends = np.cumsum(file.documents["ids"].astype(np.int64))
            for first in range(0, len(ends), 2000):
                some = ends[first : first + 2000]
                flat = file.range(at, int(some[-1]))
                out = np.split(flat, some[:-1] - at)
                known = file.documents["known"][first : first + 2000].astype(bool)
                columns = {
                    "name": pa.array([path.rsplit("/", 1)[-1]] * len(out)),
                    "doc_id": pa.array(file.documents["doc_id"][first : first + 2000], mask=~known),
                    "local": pa.array(some - file.documents["ids"][first : first + 2000].astype(np.int64)),
                    "n_tokens": pa.array(file.documents["ids"][first : first + 2000].astype(np.int64)),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in out], pa.int64()),
                    "ids": pa.array([x.tobytes() for x in out] if with_ids else [None] * len(out), pa.binary()),
                }
                at = int(some[-1])
                yield pa.RecordBatch.from_pydict(columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder).select("path", "content")
    rows = files.mapInArrow(read, "name string, doc_id long, local long, n_tokens long, ids_crc32 long, ids binary")
    joined = rows.join(manifest.select("name", "first_id"), "name")
    found = joined.select("doc_id", (F.col("first_id") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return found if with_ids else found.drop("ids")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, **options) -> DataFrame:
    """Write the files and read them back: one row per document.

    NULL and empty texts hold the end id alone. Rows with equal ids keep their
    own entries, ordered by text; NULL ids come first and stay NULL; ids are
    cast to long. An empty table writes nothing and gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/texttrend/ids-{uuid.uuid4().hex}"
    manifest = write_id_files(docs, folder, id_col, text_col, **options)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_id_files(spark, folder, manifest)
