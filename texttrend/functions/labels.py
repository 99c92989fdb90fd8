"""Sentiment labels and signed scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels a sentiment model may emit, upper-cased.
POSITIVE_LABELS = ("POSITIVE", "LABEL_2")
NEGATIVE_LABELS = ("NEGATIVE", "LABEL_0")
LABEL_THRESHOLD = 0.1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentiment_label(polarity: Column | str, threshold: float = LABEL_THRESHOLD) -> Column:
    """'positive' above the threshold, 'negative' below its negation, else 'neutral'.

    Both ends are neutral. NaN is neutral and must be tested first, because
    Spark orders NaN above every number. NULL stays NULL.
    """
    p = _col(polarity).cast("double")
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(p), "neutral")
        .when(p > threshold, "positive")
        .when(p < -threshold, "negative")
        .otherwise("neutral")
    )


def label_to_polarity(label: Column | str, score: Column | str) -> Column:
    """Model label and confidence to a signed score; other labels give 0.0."""
    name, s = F.upper(_col(label)), _col(score).cast("double")
    return (
        F.when(name.isin(*POSITIVE_LABELS), s)
        .when(name.isin(*NEGATIVE_LABELS), -s)
        .otherwise(F.lit(0.0))
    )


def drop_nan(value: Column | str) -> Column:
    """NaN to NULL, so that aggregates skip it as they skip missing values."""
    v = _col(value).cast("double")
    return F.when(~F.isnan(v), v)
