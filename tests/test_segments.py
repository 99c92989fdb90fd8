import random
import threading

import pytest
from pyspark.sql import functions as F

from texttrend.operators import index, search
from texttrend.operators.segments import SegmentStore

QUERIES = ["w1 w2", "the", "w3 w3 w4", "absent", ""]


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 20)) + ["the"] * (i % 2))) for i in range(90)]
    return spark.createDataFrame([*rows, (90, None), (91, "")], "doc_id long, text string").cache()


def rows(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 8)) for r in df.collect())


def same(found: index.SearchIndex, corpus):
    """Whether an index equals one fitted at once: totals, statistics, postings and both searches."""
    want = index.fit_index(corpus, parts=found.parts, **found.options)
    for total in ("n_docs", "n_tokens", "n_terms", "term_bytes", "n_vocabulary"):
        assert getattr(found, total) == getattr(want, total), total
    assert found.mean_idf == pytest.approx(want.mean_idf, abs=1e-12)
    assert sorted(map(tuple, found.terms.collect())) == sorted(map(tuple, want.terms.collect()))
    listed = lambda i: sorted((r.doc_id, r.term, r.tf, r.length, r.part, round(r.norm or 0, 9)) for r in i.postings.collect())
    assert listed(found) == listed(want)
    for ranker in search.RANKERS.values():
        assert rows(ranker(found, QUERIES)) == rows(ranker(want, QUERIES))


@pytest.fixture
def segments(spark, tmp_path):
    return SegmentStore(spark, f"file://{tmp_path}/store").create(parts=4, max_df=0.9)


def test_three_parts_equal_one(segments, corpus):
    for part in range(3):
        segments.add(corpus.filter(f"pmod(doc_id, 3) = {part}"))
    same(segments.load(), corpus)
    assert segments.compact().segments != [] and len(segments.state().segments) == 1
    same(segments.load(), corpus)


def test_deleted_articles_are_as_if_never_added(segments, corpus):
    segments.add(corpus.filter("doc_id < 50"))
    segments.delete(corpus.filter("doc_id BETWEEN 30 AND 60").select("doc_id"))
    segments.add(corpus.filter("doc_id >= 50"))  # ids deleted before they were added count
    live = corpus.filter("doc_id < 30 OR doc_id >= 50")
    same(segments.load(), live)
    segments.add(corpus.filter("doc_id BETWEEN 40 AND 45"))  # and deleted ones may come back
    live = live.unionByName(corpus.filter("doc_id BETWEEN 40 AND 45"))
    same(segments.load(), live)
    segments.delete(corpus.filter("doc_id IN (0, 41, 70)").select("doc_id"))
    live = live.filter("doc_id NOT IN (0, 41, 70)")
    same(segments.load(), live)
    assert segments.compact(small=20).segments  # those with deletions are merged, whatever their size
    same(segments.load(), live)
    segments.compact()
    assert [e.kind for e in segments.state().entries] == ["add"]
    same(segments.load(), live)


def test_a_large_segment_stays_beside_merged_ones(segments, corpus):
    segments.add(corpus.filter("doc_id < 60"))
    for at in (60, 70, 80):
        segments.add(corpus.filter(f"doc_id BETWEEN {at} AND {at + 9}"))
    large = segments.state().segments[0]
    segments.compact(small=30)
    assert segments.state().segments[0] == large and len(segments.state().segments) == 2
    same(segments.load(), corpus.filter("doc_id < 90"))


def test_repeated_ids_are_refused(segments, corpus):
    segments.add(corpus.filter("doc_id < 10"))
    with pytest.raises(ValueError, match="indexed documents"):
        segments.add(corpus.filter("doc_id BETWEEN 9 AND 12"))
    with pytest.raises(ValueError, match="repeats"):
        segments.add(corpus.filter("doc_id > 50").unionByName(corpus.filter("doc_id = 60")))
    same(segments.load(), corpus.filter("doc_id < 10"))


def test_writers_side_by_side(spark, segments, corpus):
    work = [lambda at=at: segments.add(corpus.filter(f"pmod(doc_id, 3) = {at}")) for at in range(3)]
    threads = [threading.Thread(target=w) for w in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert segments.state().version == 3 and len(segments.state().segments) == 3
    same(segments.load(), corpus)


def test_only_new_articles_are_tokenized(segments, corpus, monkeypatch):
    segments.add(corpus.filter("doc_id < 80"))
    seen = []
    from texttrend.operators import segments as module

    def watched(df, text="text"):
        seen.append(df.count())
        return index.with_tokens(df, text)

    monkeypatch.setattr(module, "with_tokens", watched)
    segments.add(corpus.filter("doc_id >= 80"))
    segments.compact()
    assert seen == [12]


def test_searches_read_the_folders_of_their_words(segments, corpus):
    segments.add(corpus)
    found = segments.load(norms=False)
    assert found.postings.filter(F.col("norm").isNotNull()).count() == 0
    plan = search.bm25_search(found, ["w1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan or "part#" in plan.split("PartitionFilters: [", 1)[1]


def test_empty_stores(spark, segments, tmp_path, corpus):
    with pytest.raises(ValueError, match="holds a store"):
        SegmentStore(spark, segments.path).create()
    with pytest.raises(ValueError, match="no store"):
        SegmentStore(spark, f"file://{tmp_path}/elsewhere").state()
    with pytest.raises(ValueError, match="no segment"):
        segments.load()
    segments.delete(corpus.select("doc_id"))
    segments.add(corpus.limit(0))
    assert search.bm25_search(segments.load(), ["w1"]).count() == 0
