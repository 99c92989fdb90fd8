import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from texttrend.operators import evaluation as e
from texttrend.operators.evaluation import relevance


JUDGED = "ranker string, query_id long, query string, rank int, rel double"


def lists(frame, *rels):
    rows = [(q, i + 1, float(r)) for q, rel in enumerate(rels) for i, r in enumerate(rel)]
    return frame(rows, "query_id long, rank int, rel double")


def values(df, column):
    return [r[column] for r in df.orderBy("query_id").collect()]


def test_precision(frame):
    df = lists(frame, [0, 1, 0], [1, 1, 1, 0], [0])
    assert values(e.precision_at_k(df, 10), "precision_at_k") == pytest.approx([1 / 3, 3 / 4, 0])
    assert values(e.precision_at_k(df, 2), "precision_at_k") == pytest.approx([1 / 2, 1, 0])
    assert values(e.precision_at_k(df, 0), "precision_at_k") == [0, 0, 0]


def test_ndcg(frame):
    df = lists(frame, [0, 0], [0, 1], [1, 3, 2])
    graded = (1 + 3 / math.log2(3)) / (3 + 2 / math.log2(3))
    assert values(e.ndcg_at_k(df, 2), "ndcg") == pytest.approx([0, 1 / math.log2(3), graded])
    late = lists(frame, [0, 0, 1])
    assert values(e.ndcg_at_k(late, 2), "ndcg") == [0]
    assert values(e.ndcg_at_k(df, 0), "ndcg") == [0, 0, 0]


def test_mrr(frame):
    df = lists(frame, [0, 1], [0, 0], [1])
    assert e.mean_reciprocal_rank(df).first().mrr == pytest.approx(0.5)
    asked = frame([(0,), (1,), (2,), (3,)], "query_id long")
    assert e.mean_reciprocal_rank(df, queries=asked).first().mrr == pytest.approx(0.375)
    assert e.mean_reciprocal_rank(df.filter("false")).first().mrr == 0.0


def test_report_of_empty_list_is_zero(frame):
    asked = frame([(0,), (9,)], "query_id long")
    rows = e.evaluate_ranking(lists(frame, [0, 1, 1]), 2, queries=asked).orderBy("query_id").collect()
    assert rows[0].mrr == 0.5 and rows[0].precision_at_k == 0.5 and rows[0].mean_score == 0.5
    assert rows[0].ndcg == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)))
    assert tuple(rows[1])[1:] == (0.0, 0.0, 0.0, 0.0)


def test_compare_rankers_adds_averages(frame):
    rows = [("a", 1, "x", 1, 1.0), ("a", 2, "y", 1, 0.0), ("b", 1, "x", 1, 0.0), ("b", 2, "y", 1, 0.0)]
    out = e.compare_rankers(frame(rows, JUDGED)).collect()
    assert {(r.ranker, r.query): r.mrr for r in out} == {
        ("a", "x"): 1, ("a", "y"): 0, ("a", None): 0.5, ("b", "x"): 0, ("b", "y"): 0, ("b", None): 0}


def test_queries_with_one_text_stay_two_and_those_without_rows_count(frame):
    rows = [("a", 1, "x", 1, 1.0), ("a", 2, "x", 1, 0.0), ("b", 1, "x", 1, 1.0)]
    asked = frame([(1, "x"), (2, "x"), (3, "z")], "query_id long, query string")
    out = {(r.ranker, r.query_id): (r.mrr, r.precision_at_k) for r in e.compare_rankers(frame(rows, JUDGED), queries=asked).collect()}
    assert out[("a", 1)] == (1, 1) and out[("a", 2)] == (0, 0) and out[("a", 3)] == (0, 0)
    assert out[("b", 2)] == (0, 0) and out[("a", None)][0] == pytest.approx(1 / 3) and len(out) == 8


def test_relevance(frame):
    rows = [("news", "", 1.0), ("News", "FAKE NEWS", 1.0), ("fake news", "news", 1.0), ("a", "b", 0.0), ("a", None, 1.0)]
    df = frame(rows, "q string, a string, want double")
    assert [r[0] for r in df.select(relevance("q", "a")).collect()] == [w for *_, w in rows]


def test_classification(frame):
    pairs = [("p", "p"), ("p", "n"), ("n", "n"), ("u", "n"), ("p", "z")]
    df = frame(pairs, "y_true string, y_pred string")
    assert {(r.y_true, r.y_pred): r.n for r in e.confusion_counts(df).collect()}[("p", "p")] == 1
    row = e.classification_report(df).first()
    # precision p 1, n 1/3, u 0; recall p 1/3, n 1, u 0; z has no support
    assert row.accuracy == pytest.approx(2 / 5)
    assert row.precision == pytest.approx((3 * 1 + 1 / 3) / 5)
    assert row.recall == pytest.approx(row.accuracy)
    assert row.f1_score == pytest.approx((3 * 0.5 + 0.5) / 5)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=12), min_size=30, max_size=40))
def test_metrics_match_plain_python(spark, rels):
    k = 5
    rows = [(q, i + 1, float(r)) for q, rel in enumerate(rels) for i, r in enumerate(rel)]
    report = e.evaluate_ranking(spark.createDataFrame(rows, "query_id long, rank int, rel double"), k)

    def dcg(rel):
        return sum(r / math.log2(i + 2) for i, r in enumerate(rel[:k]))

    for row in report.collect():
        rel = rels[row.query_id]
        ideal = dcg(sorted(rel, reverse=True))
        first = next((i for i, r in enumerate(rel[:k]) if r > 0), None)
        assert row.ndcg == pytest.approx(dcg(rel) / ideal if ideal else 0)
        assert row.mrr == pytest.approx(0 if first is None else 1 / (first + 1))
        assert row.precision_at_k == pytest.approx(sum(r > 0 for r in rel[:k]) / min(k, len(rel)))
        assert row.mean_score == pytest.approx(sum(rel[:k]) / len(rel[:k]))
        assert 0 <= row.ndcg <= 1
