import pytest

from texttrend.functions.labels import label_to_polarity, sentiment_label
from texttrend.operators import sentiment
from texttrend.operators.model import annotate_with_model
from texttrend.plans import views

LEXICON = [
    ("good", 0.7, None, "polar"),
    ("bad", -0.6, None, "polar"),
    ("very", None, 1.3, "modifier"),
    ("super", None, 2.0, "modifier"),
    ("not", None, None, "negation"),
]

CASES = {
    "good": 0.7,
    "good bad": 0.05,
    "very good": 0.91,
    "super good": 1.0,
    "not good": -0.35,
    "not very good": -0.455,
    "not a good": -0.35,
    "not an good": 0.7,
    "not a very good": 0.91,
    "very not good": -0.35,
    "nothing here": 0.0,
    "good very": 0.7,
    "good not": 0.7,
    "very": 0.0,
    "not": 0.0,
    "": 0.0,
    None: 0.0,
}


@pytest.mark.parametrize("large", [False, True])
def test_lexicon_rules(spark, frame, monkeypatch, large):
    if large:
        monkeypatch.setattr(sentiment, "is_small", lambda df: False)
    docs = frame([(i, t, "k") for i, t in enumerate(CASES)], "doc_id long, text string, k string")
    scores = sentiment.lexicon_scores(docs, views.lexicon(spark, LEXICON), keep=["k"])
    assert sorted(scores.columns) == ["doc_id", "k", "sentiment"]
    got = {r.doc_id: r.sentiment for r in scores.collect()}
    assert got == {i: pytest.approx(v) for i, v in enumerate(CASES.values())}


def test_annotate_keeps_rows_and_columns(spark, frame):
    docs = frame([(1, "good"), (2, "plain")], "doc_id long, text string")
    out = sentiment.annotate(docs, lexicon=views.lexicon(spark, LEXICON))
    assert {(r.doc_id, r.text, r.sentiment) for r in out.collect()} == {(1, "good", 0.7), (2, "plain", 0.0)}
    for bad in ({"method": "lexicon"}, {"method": "model"}, {"method": "other"}):
        with pytest.raises(ValueError):
            sentiment.annotate(docs, **bad)


def test_labels(frame):
    rows = [(0.1,), (-0.1,), (float("nan"),), (None,), (0.1000001,), (-0.2,)]
    got = [r[0] for r in frame(rows, "x double").select(sentiment_label("x")).collect()]
    assert got == ["neutral", "neutral", "neutral", None, "positive", "negative"]
    names = ["positive", "LABEL_2", "NEGATIVE", "LABEL_0", "neutral", "other"]
    df = frame([(n, 0.8) for n in names], "label string, score double")
    assert [r[0] for r in df.select(label_to_polarity("label", "score")).collect()] == [0.8, 0.8, -0.8, -0.8, 0.0, 0.0]


def test_model_truncates_retries_and_records_errors(frame):
    def factory():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("cannot")
            return [("POSITIVE", len(t) / 10000) for t in texts]

        return predict

    docs = frame([(1, "x" * 5000), (2, "boom"), (3, " "), (4, None), (5, "ok")], "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r for r in annotate_with_model(docs, factory).collect()}
    assert out[1].sentiment == pytest.approx(0.2048) and out[1].error is None
    assert out[2].sentiment == 0.0 and "cannot" in out[2].error
    assert out[3].sentiment == out[4].sentiment == 0.0 and out[3].error is None
    assert out[5].sentiment == pytest.approx(0.0002)
    assert len(out[1].text) == 5000


def test_model_without_its_library_fails(frame):
    def factory():
        import a_library_that_is_not_there  # noqa: F401

    with pytest.raises(Exception, match="a_library_that_is_not_there"):
        annotate_with_model(frame([(1, "x")], "doc_id long, text string"), factory).collect()


def test_one_result_for_any_lexicon_size_with_repeated_ids(spark, frame, monkeypatch):
    rows = [(1, 0, "the best license"), (1, 1, "not best"), (1, 1, "best best"), (2, 0, ""), (2, 0, None), (None, 0, "very best"), (3, None, "plain")]
    docs = frame(rows, "conv_id long, turn long, text string")
    lexicon = views.lexicon(spark)
    found = []
    for small in (True, False):
        monkeypatch.setattr(sentiment, "is_small", lambda df: small)
        scores = sentiment.lexicon_scores(docs, lexicon, keep=["turn"], id_col="conv_id").collect()
        found.append(sorted(map(tuple, scores), key=str))
    assert found[0] == found[1] and len(found[0]) == 5


def test_model_that_cannot_be_built_scores_zero(frame):
    def factory():
        raise OSError("no weights")

    row = annotate_with_model(frame([(1, "x"), (2, "")], "doc_id long, text string"), factory).orderBy("doc_id").collect()
    assert row[0].sentiment == 0.0 and "no weights" in row[0].error and row[1].error is None


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    path = str(tmp_path / "loads")

    def factory():
        import os

        with open(path, "a") as log:
            log.write(f"{os.getpid()}\n")
        return lambda texts: [("POSITIVE", 0.5)] * len(texts)

    docs = spark.range(0, 60, 1, 30).selectExpr("id AS doc_id", "'x' AS text")
    assert annotate_with_model(docs, factory).where("sentiment = 0.5").count() == 60
    loads = open(path).read().split()
    assert len(loads) == len(set(loads)) < 30
