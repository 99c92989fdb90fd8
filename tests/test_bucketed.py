import re

import pytest

from texttrend.operators import corpus as corpora
from texttrend.operators import sentiment
from texttrend.operators.model import annotate_with_model
from texttrend.plans import views


@pytest.fixture
def corpus(frame):
    rows = [(f"id{i}", f"{'best ' * (i % 3)}{'license ' * (i % 4)}word{i}", i) for i in range(200)]
    return frame([*rows, ("none", None, 1), (None, "best", 2)], "doc_id string, text string, doc int")


def test_annotate_over_a_bucketed_corpus_shuffles_nothing(spark, corpus, tmp_path):
    lexicon, path = views.lexicon(spark), f"file://{tmp_path}/corpus"
    stored = corpora.store_corpus(corpus, path, buckets=4)
    want = sorted(map(str, sentiment.annotate_sentiment(corpus, lexicon).collect()))
    for bucketed in (stored, corpora.load_corpus(spark, path)):
        for threshold in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                scored = sentiment.annotate_sentiment(bucketed, lexicon)
                got = sorted(map(str, scored.collect()))
                plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            assert got == want
            # What is shuffled is the lexicon, by its terms, before it is broadcast; no article is.
            assert set(re.findall(r"(?<!Broadcast)Exchange (\w+)\((\w+)#", plan)) <= {("hashpartitioning", "term")}
            assert "Exchange SinglePartition" not in plan


def test_buckets_follow_the_bytes_of_text(corpus, monkeypatch):
    monkeypatch.setattr(corpora, "BUCKET_BYTES", 1000)
    stored = corpora.store_corpus(corpus)
    size = sum(len(r.text or "") for r in corpus.collect())
    files = {f.rsplit("_", 1)[1] for f in stored.inputFiles()}
    assert 1 < len(files) <= -(-size // 1000)
    assert stored.count() == corpus.count()


def test_no_articles(corpus):
    assert corpora.store_corpus(corpus.limit(0)).count() == 0


def test_model_batches_are_bounded_by_characters(spark):
    texts = [("x" * n, n) for n in (1, 900, 5, 30, 2000, 2, 31, 29, 900, 899, 7, 1000) * 20]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string").coalesce(1)

    def factory():
        def predict(batch):
            padded = len(batch) * max(map(len, batch))
            # What a batch looked like comes back in the label, its text in the score.
            return [(f"{len(batch)} {padded} {max(map(len, batch)) - min(map(len, batch))}", float(len(t))) for t in batch]

        return predict

    rows = annotate_with_model(df, factory, batch_chars=4000).orderBy("doc_id").collect()
    assert [int(r.score) for r in rows] == [n for _, n in texts]  # in order
    shapes = [tuple(map(int, r.label.split())) for r in rows]
    assert all(padded <= 4000 or many == 1 for many, padded, _ in shapes)
    short = [many for (many, _, _), (_, n) in zip(shapes, texts) if n <= 31]
    assert sum(1 / many for many in short) <= 3  # 140 short texts share few batches
    assert max(many for (many, _, _), (_, n) in zip(shapes, texts) if n == 2000) <= 2
