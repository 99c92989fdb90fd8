import random

import pytest
from pyspark.sql import functions as F

from texttrend.operators import states, trends

SCORED = "source string, published_at string, sentiment double"


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "b", None]), f"2024-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}T{draw.randint(0, 23):02d}:00:00Z", 1e6 + draw.gauss(0, 0.2)) for _ in range(400)]
    rows += [("c", "2024-03-05", None), ("d", "2024-03-05", float("nan")), ("e", "never", 0.3), ("e", None, -0.3), ("f", "2024-12-31T23:59:59Z", 0.0)]
    return spark.createDataFrame(rows, SCORED)


def rounded(df, digits=7):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else str(v) for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("keys", [[], ["source"]])
def test_reports_from_states_equal_those_from_articles(scored, keys):
    kept = states.daily_states(scored, ["source"])
    assert rounded(states.distribution_of(kept, keys)) == rounded(trends.sentiment_distribution(scored, keys))


def test_deviation_survives_a_large_mean(scored):
    only = scored.filter("source = 'a' AND sentiment > 1000")
    row = states.distribution_of(states.daily_states(only)).first()
    assert row.std_sentiment == pytest.approx(only.agg(F.stddev_samp("sentiment")).first()[0], rel=1e-9)
    assert 0.1 < row.std_sentiment < 0.3


@pytest.mark.parametrize("freq", ["ME", "W", "D"])
def test_trend_from_daily_states(scored, freq):
    want = trends.sentiment_trend(scored, freq=freq, start="2024-02-10", end="2024-12-31", end_inclusive="day")
    assert rounded(states.trend_of(states.daily_states(scored), freq, "2024-02-10", "2024-12-31"), 5) == rounded(want, 5)


def test_merging_in_any_grouping_gives_the_same(scored):
    kept = states.daily_states(scored, ["source"])
    halves = [states.merge_states(kept.filter(f"coalesce(day, DATE '2000-01-01') {c} DATE '2024-06-15'"), ["source"]) for c in ("<", ">=")]
    twice = states.merge_states(halves[0].unionByName(halves[1]), ["source"])
    assert rounded(twice, 6) == rounded(states.score_states(scored, ["source"]), 6)


def test_a_batch_that_runs_again_replaces_itself(spark, scored, tmp_path):
    path = f"file://{tmp_path}/states"
    for batch, rule in (("x", "source = 'a'"), ("y", "source != 'a' OR source IS NULL"), ("x", "source = 'a'")):
        states.update_states(states.daily_states(scored.filter(rule), ["source"]), path, batch)
    want = rounded(trends.sentiment_distribution(scored, ["source"]))
    assert rounded(states.distribution_of(states.read_states(spark, path), ["source"])) == want
    states.compact_states(spark, path, f"{path}-compacted", ["day", "source"])
    assert rounded(states.distribution_of(states.read_states(spark, f"{path}-compacted"), ["source"])) == want


def test_no_articles(scored):
    none = scored.limit(0)
    assert rounded(states.distribution_of(states.daily_states(none))) == rounded(trends.sentiment_distribution(none))
    assert states.distribution_of(states.daily_states(none, ["source"]), ["source"]).count() == 0
