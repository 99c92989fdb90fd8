import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from texttrend.llm import resampling


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, longest):
    own = words(text)
    return [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]


def plain(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    """The contract, read off literally."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest))
    t = Counter(bucket(f) for x in target for f in features(x, longest))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        own = features(text, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, own)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, len(words(text))])
    eligible = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: len(eligible) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_crcs_of_all_runs_come_from_prefixes(edge_rows, longest):
    texts = [r[1] for r in edge_rows] + ["x" * 100_000 + " y", "Ab9 z_é"]
    crcs, counts = resampling.Prefixes(texts).features(longest)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert sorted(crcs[at : at + n].tolist()) == sorted(zlib.crc32(f.encode()) for f in features(text, longest))
        at += n
    assert at == len(crcs)


def test_shift_cancels_any_prefix():
    draw = random.Random(5)
    for size in (0, 1, 2, 255, 256, 70_001):
        head, tail = draw.randbytes(33), draw.randbytes(size)
        moved = resampling.shifted(np.array([zlib.crc32(head)], np.uint32), np.array([size]))
        assert int(moved[0]) ^ zlib.crc32(head + tail) == zlib.crc32(tail)


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (2, 70_000)])
def test_every_row_as_the_contract_says(given, longest, buckets):
    docs, target = given("documents"), given("benchmark")
    rows = resampling.resample(docs, target, longest=longest, buckets=buckets).collect()
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest, buckets)
    assert sorted(map(tuple, rows), key=str) == want


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    target = spark.createDataFrame([(1, None), (2, "the quick fox"), (2, "the quick fox")], "item_id long, text string")
    for least in (20, 0):
        rows = resampling.resample(edge_docs, target, percent=60, least_words=least).collect()
        want = plain([r[:2] for r in edge_rows], [None, "the quick fox", "the quick fox"], percent=60, least=least)
        assert sorted(map(tuple, rows), key=str) == want
    assert resampling.resample(no_docs, target).count() == 0
    assert resampling.resample(edge_docs, target.limit(0)).count() == len(edge_rows)


def test_drawn_rows_keep_their_columns(edge_docs, given):
    chosen = resampling.drawn(edge_docs, given("benchmark"), percent=50)
    assert chosen.columns == edge_docs.columns
    assert 0 < chosen.count() < edge_docs.count()


def test_repeated_ids_spread_over_ranges(spark):
    docs = spark.range(0, 40_000, 1, 8).selectExpr("IF(id % 3 = 0, 7L, id) AS doc_id", "repeat('one two three ', 9) AS text")
    rows = resampling.resample(docs, docs.limit(1))
    ranks = [r["rank"] for r in rows.collect() if r["rank"] is not None]
    assert sorted(ranks) == list(range(1, 4001))


def test_target_like_documents_are_drawn_first(spark):
    draw = random.Random(1)
    vocabulary = {"a": [f"alpha{i}" for i in range(50)], "b": [f"beta{i}" for i in range(50)]}
    docs = [(i, " ".join(draw.choices(vocabulary["a" if i < 40 else "b"], k=200))) for i in range(400)]
    target = [(0, " ".join(draw.choices(vocabulary["a"], k=2000)))]
    rows = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string"))
    taken = [r.doc_id for r in rows.collect() if r["rank"] is not None]
    assert len(taken) == 40 and sum(i < 40 for i in taken) >= 30
