"""Packing of token pieces into sequences by hierarchical best fit."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import rows_of, ship
from .tokens import default_tokenizer, encoder

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, ids binary"
BATCH_BYTES = 8 << 20


def token_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Each document's ids and ``end_id``, cut every ``capacity`` ids. Not materialised here."""
    schema = PIECES.format(id=docs.schema[id_col].dataType.simpleString())
    id_type = ship(docs).select(id_col).schema[0].dataType

    def cut(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        ids_of, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        out, size = [], 0

        def batch():
            columns = list(zip(*out)) or [()] * 6
            types = (to_arrow_type(id_type), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

        for doc_id, text in rows_of(batches, id_col, text_col):
            ids = ids_of.text_ids(text) + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
                size += len(part)
                if size >= BATCH_BYTES:
                    yield batch()
                    out, size = [], 0
        if out:
            yield batch()

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int]], list[int]]:
    """((bin, offset) of every item, fill of every bin), best fit by decreasing length.

    Bins with the same room share a stack, and a bit set of the rooms in use
    finds the tightest one, so an item costs the same however many bins are open.
    """
    place, fill, rooms, stacks = [(0, 0)] * len(lengths), [], 0, {}
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        need = lengths[i]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            at = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            at, room = len(fill), capacity
            fill.append(0)
        place[i] = at, capacity - room
        fill[at] += need
        if room > need:
            stacks.setdefault(room - need, []).append(at)
            rooms |= 1 << (room - need)
    return place, fill


def _packed(items: DataFrame, level: int, capacity: int) -> DataFrame:
    """Every partition packed on its own: its rows with ``bin``, ``offset`` and the bin's ``fill``."""

    def pack(batches):
        table = pa.Table.from_batches(list(batches))
        place, fill = best_fit(table.column("length").to_pylist(), capacity)
        first = (level << 56) + (TaskContext.get().partitionId() << 32)
        yield from (
            table.append_column("bin", pa.array([first + b for b, _ in place], pa.int64()))
            .append_column("offset", pa.array([o for _, o in place], pa.int64()))
            .append_column("fill", pa.array([fill[b] for b, _ in place], pa.int64()))
            .to_batches()
        )

    def guarded(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is not None:
            yield from pack([first, *batches])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ship(items).mapInArrow(guarded, f"{columns}, bin long, offset long, fill long")


def pack_items(items: DataFrame, capacity: int = 4096, slack: int = 16, fan_in: int = 8, most: int = 250_000) -> DataFrame:
    """``items`` (any columns, ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Level 0 packs each input partition where it lies. Bins filled up to
    ``slack`` are final. The others go to the next level as items of their own,
    ``fan_in`` partitions meeting in one, but never more than ``most`` items in
    a task; levels end when one partition has seen all underfull bins or a level
    merges next to nothing. Only row counts reach the driver. Every level is
    written once, so its bin numbers hold although tasks may run again.
    """
    level = store(_packed(items, 0, capacity))
    levels, parts = [level], len(level.inputFiles())
    while True:
        heads = levels[-1].where((F.col("offset") == 0) & (F.col("fill") < capacity - slack))
        open_bins = heads.select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        waiting = open_bins.count()
        if waiting < 2 or (len(levels) > 1 and parts == 1):
            break
        parts = max(-(-parts // fan_in), -(-waiting // most))
        merged = store(_packed(open_bins.repartition(parts, F.xxhash64("item")), len(levels), capacity))
        levels.append(merged)
        if merged.where("offset = 0").count() > 0.999 * waiting and parts > 1:
            break
    placed = None
    for number in range(len(levels) - 1, -1, -1):
        here = levels[number]
        if placed is None:
            sequence, base = F.col("bin"), F.lit(0)
        else:
            here = here.join(placed.withColumnsRenamed({"item": "_bin", "sequence_id": "_sequence", "at": "_at"}), F.col("bin") == F.col("_bin"), "left")
            sequence, base = F.coalesce("_sequence", "bin"), F.coalesce("_at", F.lit(0))
        here = here.withColumns({"sequence_id": sequence, "at": base + F.col("offset")})
        placed = here.select("item", "sequence_id", "at") if number else here
    return placed.select(*items.columns, "sequence_id", F.col("at").alias("offset"))


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = 4096,
    with_ids: bool = False,
    **levels,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ``ids`` if asked for.

    Documents longer than ``capacity`` ids are cut into pieces of that length
    (the last may be shorter); no other is. NULL and empty texts are the end id
    alone. Repeated rows and NULL ids are packed as often as they occur; an
    empty table gives no rows; other columns are not read. The ids are written
    to the shared folder once; packing itself moves lengths only.
    """
    pieces = store(
        token_pieces(docs, id_col, text_col, tokenizer or default_tokenizer(), end_id, capacity).withColumn(
            "_item", F.monotonically_increasing_id()
        )
    )
    packed = pack_items(pieces.drop("ids"), capacity, **levels)
    if with_ids:
        packed = packed.join(pieces.select("_item", "ids"), "_item")
    return packed.drop("_item")
