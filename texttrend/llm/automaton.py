"""Language-model scores by a weighted backoff automaton, cut to what each block of texts can reach."""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, crc_remainder, ship

ORDER, STRENGTH = 2, 4.0  # longest n-gram; pseudo-counts given to the shorter context
START, END = 1, 2  # symbols that are no words
_MIX = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

REQUEST = "bucket int, block int, grams array<binary>, counts array<binary>"
ANSWER = "block int, bucket int, counts array<binary>, known long, tokens long"
TOTALS = -1  # in place of a block: the row with what a bucket adds to the totals


def _mixed(hashes: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams that end at each place of a sequence; 0 where it is shorter. The order is part of the key."""
    total = np.full(max(0, len(hashes) - n + 1), (n * _MIX) & _MASK, np.uint64)
    for i in range(n):
        total = (total ^ hashes[i : i + len(total)]) * np.uint64(_MIX)
        total ^= total >> np.uint64(29)
    return np.concatenate([np.zeros(len(hashes) - len(total), np.uint64), total])


class Block:
    """The token places of some texts, and per order the n-gram that ends at each.

    Every text is led by order - 1 START symbols and closed by END.
    """

    def __init__(self, texts: list, order: int):
        lead = order - 1
        parts = []
        for text in texts:
            words = byte_words(text)
            own = np.empty(lead + len(words) + 1, np.uint64)
            own[:lead], own[-1] = START, END
            own[lead:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(3)), np.uint64, len(words)) | np.uint64(3)
            parts.append(own)
        size = np.array([len(x) for x in parts], np.int64)
        flat = np.concatenate(parts)
        self.tokens = size - lead
        token = np.ones(len(flat), bool)
        for i in range(lead):
            token[np.cumsum(size) - size + i] = False
        self._places = np.nonzero(token)[0]
        self._keys = [_mixed(flat, n) for n in range(1, order + 1)]

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct n-grams, where each is met first, and which of them every token ends."""
        return np.unique(self._keys[n - 1][self._places], return_index=True, return_inverse=True)


def _owned(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of the buckets that own some of these sorted keys; buckets are equal ranges of keys."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, int)
    return list(zip(bucket[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by byte position, so that Spark's compression finds the empty upper bytes."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(planes: pa.Scalar) -> np.ndarray:
    data = np.frombuffer(planes.as_buffer(), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(data.T).view("<u8").reshape(-1)


def _blocks(docs: DataFrame, id_col: str, text_col: str, held_out, block_bytes: int) -> tuple[DataFrame, int, int]:
    """Rows dealt into blocks one by one, copies too; bytes of text; training documents."""
    rows = ship(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    size = F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))
    total = rows.agg(size.alias("bytes"), F.count_if(~F.col("held_out")).alias("taught")).first()
    block = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(max(1, -(-total.bytes // block_bytes)))).cast("int")
    return rows.withColumn("block", block), total.bytes, total.taught


class Automaton:
    """The states and arcs that a block of texts can reach.

    States are contexts, the root has none. An n-gram seen in training is an
    arc from the state of its context; from any other word a failure arc leads
    to the next shorter context, down to the root, which knows every word of
    training and gives all others one share. With c for counts of training and
    q for the probability from the shorter context, an arc weighs
    log10((c(n-gram) + strength * q) / (c(context) + strength)) and a failure arc
    log10(strength / (c(context) + strength)), which is what an unseen n-gram is
    worth besides q. A state that training never met costs nothing to leave.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, known: int, documents: int, strength: float):
        floor = tokens + known + 1
        inside = np.ones(int(block.tokens.sum()), bool)
        inside[np.cumsum(block.tokens) - block.tokens] = False
        inside = np.nonzero(inside)[0]
        self._arcs, self._weights, self._seen, self._failures = [], [], [], []
        chances = before = None
        for n, total in enumerate(counts, 1):
            _, first, arc = block.distinct(n)
            if n == 1:
                chances = ((total + 1) / floor)[arc]
            else:
                context = np.full(len(arc), documents, float)  # a text's first context
                context[inside] = before[inside - 1]
                chances = (total[arc] + strength * chances) / (context + strength)
                self._failures.append(np.log10(strength / (context + strength)).tolist())
            before = total[arc]
            self._arcs.append(arc.tolist())
            self._weights.append(np.log10(chances[first]).tolist())
            self._seen.append((total > 0).tolist())

    def scores(self, sizes: list[int]) -> list[tuple[float, float, int]]:
        """(log10 probability, base score, known tokens) of every text, each read once from left to right.

        The state is the context that the next word is read from, named by its
        length: 0 is the root. A word without an arc there follows failure arcs,
        paying for each, to the first shorter context that has one; the arc leads
        to the state of the context with the word, cut to the model's order.
        """
        out, at, longest = [], 0, len(self._arcs) - 1
        words, root, known = self._arcs[0], self._weights[0], self._seen[0]
        arcs, weights, seen, failures = self._arcs, self._weights, self._seen, [None, *self._failures]
        for size in sizes:
            total = base = 0.0
            found, state = 0, longest  # a text begins behind its START symbols
            for place in range(at, at + size):
                word = words[place]
                base += root[word]
                found += known[word]
                while state and not seen[state][arcs[state][place]]:
                    total += failures[state][place]
                    state -= 1
                total += weights[state][arcs[state][place]]
                state = min(state + 1, longest) if state or known[word] else 0
            out.append((total, base, found))
            at += size
        return out


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out=None,
    order: int = ORDER,
    strength: float = STRENGTH,
    block_bytes: int = 4 << 20,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns n-gram counts of all documents for which ``held_out`` is false.
    Texts are dealt into blocks; a block asks for the counts of its distinct
    n-grams, telling how often its training texts hold them; buckets of n-grams
    add these up over all blocks and answer every block with exactly the states
    and arcs its texts can reach. A block writes to the buckets that own n-grams
    of its own and to no other, so messages are never more than the n-grams of
    the blocks, however many buckets there are; a very frequent n-gram is one
    entry per block. Only totals pass through the driver.

    NULL and blank texts are the end token alone; repeated rows and NULL ids are
    scored as often as they occur (a NULL id counts as '' for the fold); an
    empty table gives no rows; other columns are not read. Without training
    text every token is unknown.
    """
    held_out = crc_remainder(id_col, 7) == 2 if held_out is None else held_out
    blocks, size, documents = _blocks(docs, id_col, text_col, held_out, block_bytes)
    buckets = max(1, -(-size // bucket_bytes))

    def ask(table):
        own = Block(table.column("text").to_pylist(), order)
        held = np.array(table.column("held_out").to_pylist(), bool)
        taught = np.repeat(~held, own.tokens)
        none = _planes(np.zeros(0))
        rows = defaultdict(lambda: ([none] * order, [none] * order))
        for n in range(order):
            keys, _, inverse = own.distinct(n + 1)
            counts = np.bincount(inverse, weights=taught, minlength=len(keys))
            for bucket, start, end in _owned(keys, buckets):
                rows[bucket][0][n] = _planes(np.diff(keys[start:end], prepend=np.uint64(0)))
                rows[bucket][1][n] = _planes(counts[start:end])
        binaries = pa.list_(pa.binary())
        return pa.table(
            {
                "bucket": pa.array(list(rows), pa.int32()),
                "block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int32()),
                "grams": pa.array([grams for grams, _ in rows.values()], binaries),
                "counts": pa.array([times for _, times in rows.values()], binaries),
            }
        )

    def answer(table):
        asking = table.column("block").to_pylist()
        replies, known, tokens = [[] for _ in asking], 0, 0
        for n in range(order):
            asked = [np.cumsum(_numbers(g[n]), dtype=np.uint64) for g in table.column("grams")]
            grams, inverse = np.unique(np.concatenate(asked), return_inverse=True)
            given = np.concatenate([_numbers(c[n]) for c in table.column("counts")])
            totals = np.bincount(inverse, weights=given, minlength=len(grams)).astype(np.uint64)
            if n == 0:
                known, tokens = int((totals > 0).sum()), int(totals.sum())
            at = 0
            for reply, own in zip(replies, asked):
                reply.append(_planes(totals[inverse[at : at + len(own)]]))
                at += len(own)
        none = [0] * len(replies)
        return pa.table(
            {
                "block": pa.array([*asking, TOTALS], pa.int32()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (len(replies) + 1), pa.int32()),
                "counts": pa.array([*replies, []], pa.list_(pa.binary())),
                "known": pa.array([*none, known], pa.int64()),
                "tokens": pa.array([*none, tokens], pa.int64()),
            }
        )

    def traverse(texts, answers):
        own = Block(texts.column("text").to_pylist(), order)
        replies = [c for _, c in sorted(zip(answers.column("bucket").to_pylist(), answers.column("counts")), key=lambda x: x[0])]
        counts = [np.concatenate([_numbers(r[n]) for r in replies]).astype(float) for n in range(order)]
        tokens, known = (answers.column(c)[0].as_py() for c in ("tokens", "known"))
        model = Automaton(own, counts, tokens, known, documents, strength)
        scores, bases, found = zip(*model.scores(own.tokens.tolist()))
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": pa.array(own.tokens, pa.int64()),
                "n_known": pa.array(found, pa.int64()),
                "train_tokens": pa.array([tokens] * len(found), pa.int64()),
                "base_score": pa.array(bases, pa.float64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    answers = blocks.groupBy("block").applyInArrow(ask, REQUEST).groupBy("bucket").applyInArrow(answer, ANSWER)
    # One row of sums beside every answer; the messages behind both are shuffled once.
    sums = answers.where(F.col("block") == TOTALS).agg(F.sum("known").alias("known"), F.sum("tokens").alias("tokens"))
    asked = answers.where(F.col("block") != TOTALS).select("block", "bucket", "counts", sums.select(F.struct("known", "tokens")).scalar().alias("sums"))
    asked = asked.select("block", "bucket", "counts", "sums.known", "sums.tokens")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(traverse, schema)
