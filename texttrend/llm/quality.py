"""Quality scores by attention over the passages of a text (multiple-instance learning)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, packed, rows_of, sampled, ship

PASSAGE = 48  # words
# The groups of characters a passage is described by.
GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "\n", ".,;:", "!?", "#", "%", "$", "&", "*", "|", "\"'()-", "<>{}[]=/\\_~^`@+")
SPACE, OTHER, WIDE = len(GROUPS), len(GROUPS) + 1, len(GROUPS) + 2
FEATURES = len(GROUPS) + 3 + 7


def _character_groups() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    for number, group in enumerate(GROUPS):
        table[list(group.encode())] = number
    table[[9, 11, 12, 13, 32]] = SPACE
    table[128:] = WIDE
    return table


_GROUP_OF = _character_groups()


def encode_passages(text: str | None, words: int = PASSAGE) -> np.ndarray:
    """(passages, FEATURES) of a whole text: shares of character groups, word lengths, repetition.

    A passage is ``words`` words and what follows them; a text without words is
    one passage of zeros.
    """
    data = (text or "").encode("utf-8")
    groups = _GROUP_OF[np.frombuffer(data, np.uint8)]
    blank = (groups == SPACE) | (groups == 3)
    starts = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0] if len(groups) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros((1, FEATURES), np.float32)
    many = -(-len(starts) // words)
    edges = np.append(starts[::words], len(data))
    edges[0] = 0
    size = np.diff(edges)
    passage = np.repeat(np.arange(many), size)
    shares = np.bincount(passage * (WIDE + 1) + groups, minlength=many * (WIDE + 1)).reshape(many, WIDE + 1) / size[:, None]
    tokens = data.split()
    extra = np.zeros((many, 7))
    for p in range(many):
        some = tokens[p * words : (p + 1) * words]
        n = len(some)
        lowered = [t.lower() for t in some]
        extra[p] = (
            n / words,
            len(set(lowered)) / n,
            sum(a == b for a, b in zip(lowered, lowered[1:])) / n,
            sum(len(t) for t in some) / n / 10,
            sum(t.isupper() for t in some) / n,
            sum(not t[-1:].isalnum() for t in some) / n,
            len(set(lowered).difference(tokens[max(0, (p - 1) * words) : p * words])) / n,
        )
    return np.concatenate([shares, extra], axis=1).astype(np.float32)


@dataclass
class AttentionModel:
    """Gated attention over encoded passages, then a logistic score of their weighted sum."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, passages: np.ndarray) -> float:
        """Score from 0 to 1 of one text's passages."""
        if self.constant is not None:
            return self.constant
        x = (passages - self.mean) / self.scale
        return float(_forward(self.weights, x, np.zeros(1, np.int64), np.zeros(len(x), np.int64))[0][0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(w: dict, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> tuple:
    """Scores of bags of passages (``first``: where each begins; ``bag``: each passage's) and what training needs."""
    h = np.tanh(x @ w["encode"] + w["encode_0"])
    view, gate = np.tanh(h @ w["view"]), _sigmoid(h @ w["gate"])
    energy = (view * gate) @ w["attend"]
    energy = np.exp(energy - np.maximum.reduceat(energy, first)[bag])
    attention = energy / np.add.reduceat(energy, first)[bag]
    pooled = np.add.reduceat(attention[:, None] * h, first)
    return _sigmoid(pooled @ w["out"] + w["out_0"]), h, view, gate, attention, pooled


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 16, attend: int = 8, steps: int = 600, batch: int = 512, rate: float = 0.01, seed: int = 5) -> AttentionModel:
    """Fit by Adam on the document labels; without both labels the score is their smoothed share."""
    labels = np.asarray(labels, float)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), {}, float(share))
    flat = np.concatenate(bags).astype(float)
    mean, scale = flat.mean(axis=0), flat.std(axis=0) + 0.02
    random = np.random.default_rng(seed)
    draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"encode": draw(FEATURES, hidden), "encode_0": np.zeros(hidden), "view": draw(hidden, attend), "gate": draw(hidden, attend), "attend": draw(attend), "out": draw(hidden), "out_0": np.zeros(())}
    slow, fast = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(bags)):
            order = random.permutation(len(bags))
        chosen, order = order[:batch], order[batch:]
        x = (np.concatenate([bags[i] for i in chosen]) - mean) / scale
        size = np.array([len(bags[i]) for i in chosen])
        first, bag = np.cumsum(size) - size, np.repeat(np.arange(len(chosen)), size)
        score, h, view, gate, attention, pooled = _forward(w, x, first, bag)
        d = (score - labels[chosen]) / len(chosen)
        g = {"out": pooled.T @ d, "out_0": d.sum()}
        into_pool = d[:, None] * w["out"]
        dh = attention[:, None] * into_pool[bag]
        da = (h * into_pool[bag]).sum(axis=1)
        de = attention * (da - np.add.reduceat(attention * da, first)[bag])
        g["attend"] = (view * gate).T @ de
        mixed = de[:, None] * w["attend"]
        dview, dgate = mixed * gate * (1 - view**2), mixed * view * gate * (1 - gate)
        g["view"], g["gate"] = h.T @ dview, h.T @ dgate
        dh += dview @ w["view"].T + dgate @ w["gate"].T
        inner = dh * (1 - h**2)
        g["encode"], g["encode_0"] = x.T @ inner, inner.sum(axis=0)
        for k in w:
            g[k] = g[k] + 1e-4 * w[k]
            slow[k] = 0.9 * slow[k] + 0.1 * g[k]
            fast[k] = 0.999 * fast[k] + 0.001 * g[k] ** 2
            w[k] = w[k] - rate * (slow[k] / (1 - 0.9**step)) / (np.sqrt(fast[k] / (1 - 0.999**step)) + 1e-8)
    return AttentionModel(mean, scale, w)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = 6000) -> AttentionModel:
    """Train on about ``most`` labelled documents outside the held-out fold (all if they are fewer), chosen by a hash of their id.

    Held out are ids whose crc32 as text leaves 2 modulo 4. The bound keeps
    training on the driver small; only encoded passages of the chosen documents
    reach it. Rows without an id or a label of 0 or 1 are not used.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (crc_remainder("_id", 4) != 2)
    )
    labelled = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    chosen = sampled(labelled, labelled.count(), most, "_id")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")

    def encode(batches):
        for text, label in rows_of(batches, "_text", "_label"):
            yield pa.RecordBatch.from_pydict({"bag": [encode_passages(text).tobytes()], "label": [label]}, schema=pa.schema([("bag", pa.binary()), ("label", pa.int32())]))

    rows = ship(texts).mapInArrow(encode, "bag binary, label int").toArrow()
    rows = sorted(zip(rows.column("bag").to_pylist(), rows.column("label").to_pylist()))
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b, _ in rows]
    return train(bags, np.array([y for _, y in rows]))


def with_score(docs: DataFrame, model: AttentionModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the model's score of every whole text; only the text is looked at."""

    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(encode_passages(t.as_py())) for t in texts], pa.float64())

    return ship(docs).withColumn(name, F.arrow_udf(score, "double")(F.col(text_col)))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **fitting) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    NULL and blank texts are scored as one empty passage; repeated rows and NULL
    ids are scored as often as they occur; an empty table gives no rows; without
    usable labels every score is 0.5; other columns are not read.
    """
    model = fit(docs, labels, id_col, text_col, **fitting)
    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_remainder(id_col, 4) == 2).alias("held_out"), F.col(text_col).alias("_text"))
    scored = with_score(rows, model, "_text").drop("_text")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **fitting) -> DataFrame:
    """``docs`` without the rows scored below ``threshold``; all columns kept. Texts are treated as in score_documents."""
    model = fit(docs, labels, id_col, text_col, **fitting)
    scored = with_score(docs.select(packed(docs), F.col(text_col).alias("_text")), model, "_text", "_score")
    return scored.where(F.col("_score") >= threshold).select("_row.*")
