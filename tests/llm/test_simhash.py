import numpy as np
import xxhash
from pyspark.sql import functions as F

from texttrend.llm import simhash
from texttrend.llm.components import components
from texttrend.session import store


def slow_hash(text, width=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(points, bits=2):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, p in enumerate(points):
        for j in range(i):
            if bin(p ^ points[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def test_edge_rows_match_brute_force(edge_docs, edge_rows):
    got = sorted(((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(edge_docs).collect()), key=str)
    prints = [slow_hash(r[1]) for r in edge_rows]
    classes = slow_classes(prints)
    least = {}
    for r, c in zip(edge_rows, classes):
        least[c] = min(least.get(c, float("inf")), float("inf") if r[0] is None else r[0])
    want = sorted(((r[0] is None, r[0], f"{p:016x}", None if least[c] == float("inf") else least[c]) for r, p, c in zip(edge_rows, prints, classes)), key=str)
    assert got == want


def test_given_documents_match_brute_force(given):
    rows = sorted(simhash.near_duplicates(given("documents")).collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in given("documents").collect()}
    points = [int(r.fingerprint, 16) for r in rows]
    assert points == [slow_hash(texts[r.doc_id]) for r in rows]
    assert [r.component_id for r in rows] == [rows[c].doc_id for c in slow_classes(points)]


def test_trees_lose_no_link(spark):
    random = np.random.default_rng(1)
    centres = random.integers(0, 1 << 63, 40, dtype=np.uint64)
    points = [int(c) for c in centres]
    for _ in range(1500):
        p = int(random.choice(points[-300:]))
        for bit in random.choice(64, int(random.integers(0, 5)), replace=False):
            p ^= 1 << int(bit)
        points.append(p)
    points = sorted(set(points))
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    want = slow_classes(points)
    table = store(spark.createDataFrame([(p,) for p in signed], "fp long"))
    for parts, shard_rows, sample_rows in ((1, 8, 1 << 18), (2, 8, 1 << 18), (3, 8, 1 << 18), (2, 8, 64), (1, 16, 32)):
        links = simhash.near_links(table, "fp", 2, parts, shard_rows, sample_rows)
        root = {r.node: r.root for r in components(links, "a", "b").collect()}
        groups = {}
        for p, c in zip(signed, want):
            groups.setdefault(c, set()).add(root.get(p, p))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_shards_stay_small_beyond_the_sample(spark):
    """With a sample that does not grow, second trees keep comparisons from growing with the square of the rows."""
    random = np.random.default_rng(5)
    compared, largest = [], []
    for rows in (10_000, 40_000):
        signed = np.unique(random.integers(0, 1 << 63, rows, dtype=np.uint64)).view(np.int64).tolist()
        table = store(spark.createDataFrame([(p,) for p in signed], "fp long"))
        sizes = simhash.dealt_blocks(table, "fp", 2, 2, 64, 256).groupBy("shard").agg(F.count_if(F.col("home")).alias("h"), F.count_if(~F.col("home")).alias("v")).collect()
        assert {r.shard >> 24 & 1 for r in sizes if (r.shard >> 24) % (1 << 20)} == {0, 1}  # shards of second trees
        compared.append(sum(r.h * r.v for r in sizes) / rows)
        largest.append(max(r.h for r in sizes))
    assert max(largest) <= 8 * 64
    assert compared[1] < 2.5 * compared[0]  # 4 if shards grew with the rows


def test_components_follow_long_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_one_row_of_a_class_stays(edge_docs, no_docs):
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 9, 10] or len(ids) == len({r.component_id for r in simhash.near_duplicates(edge_docs).collect()})
    assert simhash.drop_near_duplicates(no_docs).count() == 0 == simhash.near_duplicates(no_docs).count()


def test_a_sample_is_drawn_by_a_threshold(spark):
    """No sort and no single task: each row is decided where it lies."""
    from texttrend.llm.common import sampled

    rows = spark.range(20_000).selectExpr("xxhash64(id) AS f")
    drawn = sampled(rows, 20_000, 500, "f")
    assert 400 < drawn.count() < 600
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "Sort" not in plan and "Exchange" not in plan
    assert sampled(rows, 20_000, 20_000, "f").count() == 20_000
