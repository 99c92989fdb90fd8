import datetime as dt

import pytest

from texttrend.operators import trends

NAN = float("nan")


def test_distribution_edges(frame):
    def row(values):
        return tuple(trends.sentiment_distribution(frame([(v,) for v in values], "sentiment double")).first())

    assert row([]) == row([None, NAN]) == (0.0, 0.0, 0.0, 0.0, 0.0)
    assert row([0.5]) == (0.5, None, 1.0, 0.0, 0.0)
    assert row([NAN, 0.1, None, -0.1]) == (0.0, pytest.approx(0.1414213562), 0.0, 0.0, 1.0)
    with pytest.raises(ValueError):
        trends.sentiment_distribution(frame([(1,)], "x int"))


def test_distribution_by_key(frame):
    df = frame([("a", 0.2), ("a", -0.2), ("b", None)], "k string, sentiment double")
    out = {r.k: r for r in trends.sentiment_distribution(df, ["k"]).collect()}
    assert out["a"].positive_ratio == out["a"].negative_ratio == 0.5 and out["b"].mean_sentiment == 0.0


def test_monthly_trend_edges(frame):
    rows = [
        ("2024-12-31T00:00:00Z", 1.0),
        ("2024-12-31T09:00:00Z", 5.0),
        ("", 9.0),
        ("2024-01-31T23:59:59Z", 0.25),
        ("2024-01-01T00:00:00Z", NAN),
        ("2023-12-31T23:59:59Z", 9.0),
    ]
    df = frame(rows, "published_at string, sentiment double")
    out = {r.label: (r.sentiment, r.n) for r in trends.sentiment_trend(df).collect()}
    assert len(out) == 12
    assert out["2024-12"] == (1.0, 1) and out["2024-01"] == (0.25, 1) and out["2024-06"] == (None, 0)
    whole = {r.label: r.n for r in trends.sentiment_trend(df, end_inclusive="day").collect()}
    assert whole["2024-12"] == 2


def test_week_labels(frame):
    df = frame([(dt.datetime(2024, 2, 4, 10), 1.0), (dt.datetime(2024, 2, 5), 3.0)], "t timestamp, sentiment double")
    out = {r.label: r.sentiment for r in trends.sentiment_trend(df, "t", freq="W", start="2024-02-01", end="2024-02-11").collect()}
    assert out == {"2024-02-04": 1.0, "2024-02-11": 3.0}
    days = trends.sentiment_trend(df, "t", freq="D", start="2024-02-03", end="2024-02-05")
    assert {r.label: r.sentiment for r in days.collect()} == {"2024-02-03": None, "2024-02-04": 1.0, "2024-02-05": 3.0}
    with pytest.raises(ValueError):
        trends.sentiment_trend(df, "t", freq="Q")
    with pytest.raises(ValueError):
        trends.time_filter(df, "t", end_inclusive="never")


def test_unparsed_times_are_split_off(frame):
    df = frame([("2024-01-01T00:00:00Z",), ("",), (None,), ("soon",)], "published_at string")
    usable, rejected = trends.split_unparsed(df)
    assert usable.count() == 3 and [r[0] for r in rejected.collect()] == ["soon"]
