"""SimHash fingerprints and exact near-duplicate classes by vantage-point trees."""

from __future__ import annotations

import pickle
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import byte_words, packed, sampled, ship
from .components import components

BITS = 64
CHUNK = 1 << 15  # shingles counted at once, whatever the text's length


def simhash(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles: a bit is set if it is in over half the hashes."""
    words = byte_words(text)
    if not words:
        return 0
    if len(words) < width:
        shingles, total = [b" ".join(words)], 1
    else:
        shingles, total = map(b" ".join, zip(*(words[i:] for i in range(width)))), len(words) - width + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, CHUNK):
        part = np.fromiter(hashes, np.uint64, min(CHUNK, total - start))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str, name: str, width: int = 3) -> DataFrame:
    """``docs`` with the SimHash of ``text_col`` as a signed long; no text (NULL, blank) gives 0."""

    def hashed(texts: pa.Array) -> pa.Array:
        values = (simhash(t.as_py(), width) for t in texts)
        return pa.array(np.fromiter(values, np.uint64, len(texts)).view(np.int64))

    return ship(docs).withColumn(name, F.arrow_udf(hashed, "long")(F.col(text_col)))


def as_hex(fingerprint: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- the tree ------------------------------------------------------------------------------------


class VantageTree:
    """A vantage-point tree over Hamming distance, as flat arrays that are shipped to the tasks.

    Inner node i sends a point within ``radius[i]`` of ``pivot[i]`` to
    ``inside[i]``, any other to ``outside[i]``; children below zero are leaves.
    """

    def __init__(self, sample: np.ndarray, leaf: int, reach: int, seed: int = 7):
        self.pivot, self.radius, self.children, self.leaves, self.reach = [], [], [], 0, reach
        self._random = np.random.default_rng(seed)
        self.root = self._grow(np.unique(sample), leaf)
        self.pivot = np.array(self.pivot, np.uint64)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        if len(points) <= leaf:
            return self._leaf()
        best = None
        for pivot in self._random.choice(points, min(8, len(points)), replace=False):
            d = np.bitwise_count(points ^ pivot).astype(np.int16)
            radius = int(np.median(d))
            radius -= radius == d.max()
            inside = int((d <= radius).sum())
            if not 0 < inside < len(points):
                continue
            visits = int((d <= radius + self.reach).sum()) ** 2 + int((d > radius - self.reach).sum()) ** 2
            if best is None or visits < best[0]:
                best = visits, pivot, radius, d
        if best is None:
            return self._leaf()
        _, pivot, radius, d = best
        node = len(self.pivot)
        self.pivot.append(pivot)
        self.radius.append(radius)
        self.children.append(None)
        self.children[node] = self._grow(points[d <= radius], leaf), self._grow(points[d > radius], leaf)
        return node

    def visits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, index of the point, whether it lives there) for every leaf a point must see.

        A branch is pruned when the triangle inequality rules out that it holds
        a point within ``reach``.
        """
        out, stack = [], [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while stack:
            node, index, home = stack.pop()
            if not len(index):
                continue
            if node < 0:
                out.append((np.full(len(index), -node - 1), index, home))
                continue
            d = np.bitwise_count(points[index] ^ self.pivot[node]).astype(np.int16)
            radius, (inside, outside) = self.radius[node], self.children[node]
            near, far = d <= radius + self.reach, d > radius - self.reach
            stack.append((inside, index[near], home[near] & (d[near] <= radius)))
            stack.append((outside, index[far], home[far] & (d[far] > radius)))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(x) for x in zip(*out))


def _parts(fingerprints: np.ndarray, parts: int) -> list[np.ndarray]:
    """Consecutive bit ranges of the fingerprints."""
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(fingerprints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def _loads(batches, trees):
    """Per leaf: how many points live there and how many visit, added up per task."""
    totals = [np.zeros((2, t.leaves), np.int64) for t in trees]
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for tree, total, part in zip(trees, totals, _parts(points, len(trees))):
            leaf, _, home = tree.visits(part)
            total[0] += np.bincount(leaf[home], minlength=tree.leaves)
            total[1] += np.bincount(leaf, minlength=tree.leaves)
    for k, total in enumerate(totals):
        yield pa.RecordBatch.from_pydict(
            {"tree": pa.array([k] * total.shape[1], pa.int32()), "leaf": pa.array(np.arange(total.shape[1])), "homes": pa.array(total[0]), "visits": pa.array(total[1])}
        )


def _blocks(shard, point, home, rows, columns):
    """Batches that send each resident to all blocks of its row and each visitor to all blocks of its column."""
    mix = ((point * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)
    for side, fixed, across in ((home, rows, columns), (np.ones(len(shard), bool), columns, rows)):
        number, repeat_ = mix[side] % fixed[side], across[side]
        who = np.repeat(np.arange(len(number)), repeat_)
        other = np.arange(len(who)) - np.repeat(np.cumsum(repeat_) - repeat_, repeat_)
        resident = side is home
        i, j = (number[who], other) if resident else (other, number[who])
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array(shard[side][who] + (i << 12) + j),
                "fp": pa.array(point[side][who].view(np.int64)),
                "home": pa.array(np.full(len(who), resident)),
            }
        )


def _cuts(homes: np.ndarray, visits: np.ndarray, shard_rows: int) -> np.ndarray:
    """(rows, columns) of the blocks of shards with so many residents and visitors."""
    return np.clip(-(-np.stack([homes // 4, visits // 16]) // shard_rows), 1, (1 << 12) - 1)


def _visits(batches, trees):
    """(tree, fingerprints, shard, whether it lives there) for every visit of every tree."""
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k, (tree, part) in enumerate(zip(trees, _parts(points, len(trees)))):
            leaf, index, home = tree.visits(part)
            yield k, points[index], leaf, home


def _deal(batches, trees, cuts, crowded):
    """Each fingerprint once per block of a shard it lives in or visits, crowded shards left out."""
    for k, point, leaf, home in _visits(batches, trees):
        calm = crowded[k][leaf] == 0
        point, leaf, home = point[calm], leaf[calm], home[calm]
        yield from _blocks((k * trees[k].leaves + leaf) << 44, point, home, *cuts[k][:, leaf])


def _deal_crowded(batches, trees, crowded, share):
    """(shard, slice, slices, fp, home): visits of the crowded shards, a hash's ``share`` of the fingerprints."""
    for k, point, leaf, home in _visits(batches, trees):
        drawn = (point * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40) < share * (1 << 24)
        mine = drawn & (crowded[k][leaf] > 0)
        point, leaf, home = point[mine], leaf[mine], home[mine]
        slices = crowded[k][leaf]
        mix = ((point * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array(k * trees[k].leaves + leaf),
                "slice": pa.array(mix % slices),
                "slices": pa.array(slices),
                "fp": pa.array(point.view(np.int64)),
                "home": pa.array(home),
            }
        )


def _second_trees(crowded: DataFrame, sample: DataFrame, share: float, parts: int, leaves: int, reach: int, shard_rows: int) -> DataFrame:
    """Blocks (shard, fp, home) of the crowded shards, each dealt by a tree grown from the sample of its own residents.

    The trees stay in a table and meet the slices of their shard in a join; the
    driver sees none. What the sample misjudges changes the size of a block,
    not what is compared.
    """
    few = max(4, int(shard_rows * share))

    def grow(table: pa.Table) -> pa.Table:
        shard, slices = table.column("shard")[0].as_py(), table.column("slices")[0].as_py()
        part = _parts(table.column("fp").to_numpy().view(np.uint64), parts)[shard // leaves]
        lives = table.column("home").to_numpy(zero_copy_only=False)
        tree = VantageTree(part[lives], few, reach)
        leaf, index, home = tree.visits(part)
        homes, visits = np.bincount(leaf[home & lives[index]], minlength=tree.leaves), np.bincount(leaf, minlength=tree.leaves)
        grown = pickle.dumps((tree, _cuts((homes / share).astype(np.int64), (visits / share).astype(np.int64), shard_rows)))
        return pa.table({"shard": pa.array([shard] * slices, pa.int64()), "slice": pa.array(range(slices), pa.int64()), "grown": [grown] * slices})

    def place(rows: pa.Table, own: pa.Table) -> pa.Table:
        schema = pa.schema([("shard", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])
        if not len(rows):
            return schema.empty_table()
        shard = rows.column("shard")[0].as_py()
        point, lives = rows.column("fp").to_numpy().view(np.uint64), rows.column("home").to_numpy(zero_copy_only=False)
        tree, cuts = pickle.loads(own.column("grown")[0].as_py()) if len(own) else (VantageTree(point[:0], few, reach), np.ones((2, 1), np.int64))
        leaf, index, home = tree.visits(_parts(point, parts)[shard // leaves])
        return pa.Table.from_batches(_blocks((shard << 44) + (leaf + 1 << 24), point[index], home & lives[index], *cuts[:, leaf]), schema)

    trees = sample.groupBy("shard").applyInArrow(grow, "shard long, slice long, grown binary")
    return crowded.groupBy("shard", "slice").cogroup(trees.groupBy("shard", "slice")).applyInArrow(place, "shard long, fp long, home boolean")


def _linked(nodes: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label reachable, by repeated minima over the links."""
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _forest(table: pa.Table, max_bits: int) -> pa.Table:
    """Links (node, root) that connect what lies within ``max_bits`` in one block."""
    points = table.column("fp").to_numpy().view(np.uint64)
    home = table.column("home").to_numpy(zero_copy_only=False)
    nodes = np.unique(points)
    homes, seekers = np.unique(points[home]), np.unique(points[~home])
    home_at = np.searchsorted(nodes, homes)
    label = np.arange(len(nodes))
    step = max(1, (1 << 21) // max(1, len(homes)))
    for start in range(0, len(seekers), step):
        some = seekers[start : start + step]
        q, p = np.nonzero(np.bitwise_count(some[:, None] ^ homes[None, :]) <= max_bits)
        a, b = np.searchsorted(nodes, some[q]), home_at[p]
        apart = label[a] != label[b]
        if apart.any():
            label = _linked(len(nodes), label[a[apart]], label[b[apart]], label)
    moved = label != np.arange(len(nodes))
    return pa.table({"a": nodes[moved].view(np.int64), "b": nodes[label[moved]].view(np.int64)})


def dealt_blocks(fingerprints: DataFrame, name: str, max_bits: int, parts: int, shard_rows: int, sample_rows: int) -> DataFrame:
    """Blocks (shard, fp, home) in which any two distinct fingerprints at most ``max_bits`` apart meet, one at home there."""
    rows = ship(fingerprints).count()
    if rows == 0:
        return fingerprints.select(F.lit(0).cast("long").alias("shard"), F.col(name).alias("fp"), F.lit(True).alias("home"))
    one = fingerprints.select(name)
    points = sampled(one, rows, sample_rows, name).toArrow().column(0).to_numpy().view(np.uint64)
    leaf = max(4, shard_rows * len(points) // rows)
    reach = max_bits // parts
    trees = [VantageTree(p, leaf, reach) for p in _parts(points, parts)]
    most = max(t.leaves for t in trees)
    for t in trees:  # one numbering for all
        t.leaves = most
    loads = (
        one.mapInArrow(partial(_loads, trees=trees), "tree int, leaf long, homes long, visits long")
        .groupBy("tree", "leaf")
        .agg(F.sum("homes").alias("homes"), F.sum("visits").alias("visits"))
        .toArrow()
    )
    homes, visits = np.zeros((2, parts, most), np.int64)
    at = loads.column("tree").to_numpy(), loads.column("leaf").to_numpy()
    homes[at], visits[at] = loads.column("homes").to_numpy(), loads.column("visits").to_numpy()
    cuts = [_cuts(h, v, shard_rows) for h, v in zip(homes, visits)]
    crowded = np.where(homes > 4 * shard_rows, -(-visits // (32 * shard_rows)), 0)  # slices of each crowded shard
    dealt = one.mapInArrow(partial(_deal, trees=trees, cuts=cuts, crowded=crowded), "shard long, fp long, home boolean")
    if not crowded.any():
        return dealt
    share = min(1.0, 8 / shard_rows)
    schema = "shard long, slice long, slices long, fp long, home boolean"
    sample, whole = (one.mapInArrow(partial(_deal_crowded, trees=trees, crowded=crowded, share=s), schema) for s in (share, 1.0))
    return dealt.unionByName(_second_trees(whole, sample, share, parts, most, reach, shard_rows))


def near_links(
    fingerprints: DataFrame, name: str, max_bits: int = 2, parts: int = 2, shard_rows: int = 2048, sample_rows: int = 1 << 18
) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most ``max_bits`` apart.

    ``fingerprints`` is a stored table of distinct values. Two fingerprints
    within ``max_bits`` agree up to ``max_bits // parts`` bits in one of
    ``parts`` bit ranges, so each range has a tree of its own, searched with
    that smaller reach: fewer shards overlap. The trees (medians, vantage
    points) come from about ``sample_rows`` fingerprints; they only decide how
    rows are dealt, every fingerprint is searched. That sample does not grow
    with the input, so a shard that it leaves with more than four times
    ``shard_rows`` residents grows a second tree from a sample of its own, in a
    task. What no tree can split (texts a few bits apart) is compared block by
    block. Inside a block, links are reduced to a spanning forest, so a dense
    group yields as many links as it has members.
    """
    dealt = dealt_blocks(fingerprints, name, max_bits, parts, shard_rows, sample_rows)

    def forest(block):
        return _forest(block, max_bits)

    return dealt.groupBy("shard").applyInArrow(forest, "a long, b long")


def near_duplicate_classes(hashed: DataFrame, id_col: str, name: str, max_bits: int = 2, **tree) -> DataFrame:
    """Rows (fingerprint, class, component_id) for every distinct fingerprint of a stored table.

    class is the smallest fingerprint reachable.

    component_id is the smallest id reachable over links of at most ``max_bits``
    bits, NULL only if no row reached has an id. Exact copies share a
    fingerprint and are one node, so they are pre-aggregated, not paired.
    """
    distinct = store(hashed.groupBy(name).agg(F.min(id_col).alias("_least")))
    roots = components(near_links(distinct, name, max_bits, **tree), "a", "b")
    rooted = distinct.join(roots, distinct[name] == roots["node"], "left").select(
        name, "_least", F.coalesce("root", name).alias("_root")
    )
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return rooted.join(least, "_root").select(name, F.col("_root").alias("class"), "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2, **tree) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    NULL and blank texts have fingerprint zero and are linked like any other;
    repeated rows and NULL ids are returned as often as they occur; an empty
    table gives no rows. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    hashed = store(with_fingerprint(source, "_text", "_fp", width).select("doc_id", "_fp"))
    classes = near_duplicate_classes(hashed, "doc_id", "_fp", max_bits, **tree)
    return hashed.join(classes, "_fp").select("doc_id", as_hex("_fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2, **tree) -> DataFrame:
    """One row of each near-duplicate class: the one with the smallest id (NULL last), all columns kept.

    Rows that repeat an id within a class leave one row. The hashed rows are
    written once, so that their row numbers hold for all later steps.
    """
    work = docs.select(packed(docs), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    hashed = store(with_fingerprint(work, "_text", "_fp", width).select("_row", "_id", "_fp", F.monotonically_increasing_id().alias("_n")))
    classes = near_duplicate_classes(hashed.select("_id", "_fp"), "_id", "_fp", max_bits, **tree)
    kept = (
        hashed.select("_id", "_fp", "_n")
        .join(classes, "_fp")
        .groupBy("class")
        .agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_n")).alias("first"))
        .select(F.col("first._n").alias("_n"))
    )
    return hashed.join(kept, "_n", "left_semi").select("_row.*")
