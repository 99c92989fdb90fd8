"""What an index costs must follow the corpus, and each task's share must not."""

import random
import re

import pytest

from texttrend.operators import bounds
from texttrend.operators import index as ix
from texttrend.operators.segments import SegmentStore


def test_buckets_of_an_index_do_not_grow():
    for tokens in (10**7, 10**8, 10**9, 10**10, 10**11):
        _, buckets = ix.postings_layout(tokens)
        assert tokens / buckets < 10_000_000  # a task sorts these twice, about 190 bytes a word


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(draw.choices(words, weights=range(80, 0, -1), k=draw.randint(0, 30)) + [f"own{i}"] * (i % 3))) for i in range(120)]
    return spark.createDataFrame([*rows, (120, None), (121, "own7 own8")], "doc_id long, text string")


def postings(index):
    return sorted((r.doc_id, r.term, r.tf, r.length, None if r.norm is None else round(r.norm, 9)) for r in index.postings.collect())


def shuffles(df):
    return re.findall(r"Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("most", [-1, 600, 3000])
def test_rare_words_beyond_the_broadcast_give_the_same_norms(spark, corpus, monkeypatch, most):
    want = ix.fit_index(corpus, parts=2)
    monkeypatch.setattr(ix, "BROADCAST_BYTES", most)
    frequent, rare = ix.split_idf(want)
    assert rare.count() and rare.join(frequent, "term").isEmpty()
    assert frequent.filter("idf IS NOT NULL").count() + rare.count() == want.n_vocabulary
    assert postings(ix.fit_index(corpus, parts=2)) == postings(want)


def test_postings_are_shuffled_once_into_blocks(corpus):
    stored = ix.fit_index(corpus)
    assert len(shuffles(bounds._blocks(stored, 8, 2, 4, 4))) == 1
    assert shuffles(bounds._blocks(stored, 8, 2, 4, 4)) == ["hashpartitioning"]


def test_files_of_blocks_do_not_grow():
    assert bounds.FILE_BYTES <= 64 << 20


@pytest.mark.parametrize("most", [-1, 600])
def test_norms_of_segments_with_rare_words_beyond_the_broadcast(spark, corpus, monkeypatch, tmp_path, most):
    want = ix.fit_index(corpus, parts=4)
    monkeypatch.setattr(ix, "BROADCAST_BYTES", most)
    kept = SegmentStore(spark, f"file://{tmp_path}/store").create(parts=4)
    kept.add(corpus.filter("doc_id < 70"))
    kept.add(corpus.filter("doc_id >= 70"))
    assert postings(kept.load()) == postings(want)
