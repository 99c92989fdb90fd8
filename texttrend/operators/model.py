"""Batch model inference in Arrow batches, the one place Python workers are used."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_to_polarity
from ..functions.text import MODEL_MAX_CHARS, truncate_text

PREDICTION = "label string, score double, error string"
# Characters of a model batch, padding included: texts of one batch are padded to its longest.
BATCH_CHARS = 64 * MODEL_MAX_CHARS


def _prediction_udf(predictor_factory: Callable, batch_chars: int):
    """UDF from text batches to (label, score, error).

    ``predictor_factory()`` runs once per worker process and returns a function
    from a list of texts to a list of (label, score). A missing library is
    raised. A factory that fails otherwise gives every text that error; a failure
    on texts is retried text by text and recorded in ``error``. The texts of an
    Arrow batch are taken by length into model batches of at most ``batch_chars``
    characters, padding included (or one text), and their results put back in
    order. Defined inside a function so that workers need not import this package.
    """
    from pyspark import cloudpickle

    key = hashlib.sha256(cloudpickle.dumps(predictor_factory)).hexdigest()

    def predict(batches):
        import sys

        import pandas as pd

        # Workers are used for many tasks; what belongs to the process is kept beside its modules.
        loaded = sys.__dict__.setdefault("_texttrend_predictors", {})
        if key not in loaded:
            try:
                loaded[key] = predictor_factory(), None
            except ImportError:
                raise
            except Exception as exc:
                loaded[key] = None, f"{type(exc).__name__}: {exc}"
        predictor, broken = loaded[key]

        def one(text):
            try:
                label, score = predictor([text])[0]
                return str(label), float(score), None
            except ImportError:
                raise
            except Exception as exc:
                return None, None, f"{type(exc).__name__}: {exc}"

        def batch(texts):
            try:
                found = [(str(label), float(score), None) for label, score in predictor(texts)]
                if len(found) == len(texts):
                    return found
            except ImportError:
                raise
            except Exception:
                pass
            return [one(text) for text in texts]

        def by_length(texts):
            # Shortest first: a batch's last text is its longest, to which the others are padded.
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            found, start = [None] * len(texts), 0
            for end in range(1, len(order) + 1):
                if end == len(order) or (end + 1 - start) * len(texts[order[end]]) > batch_chars:
                    part = order[start:end]
                    for i, row in zip(part, batch([texts[i] for i in part])):
                        found[i] = row
                    start = end
            return found

        for series in batches:
            rows = [(None, None, None)] * len(series)
            asked = [i for i, text in enumerate(series) if text is not None and text.strip()]
            found = [(None, None, broken)] * len(asked) if broken else by_length([series.iloc[i] for i in asked])
            for i, row in zip(asked, found):
                rows[i] = row
            yield pd.DataFrame(rows, columns=["label", "score", "error"])

    from collections.abc import Iterator

    import pandas as pd

    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(predict, PREDICTION)


def annotate_with_model(
    corpus: DataFrame, predictor_factory: Callable, text: str = "text", max_chars: int = MODEL_MAX_CHARS, batch_chars: int = BATCH_CHARS
) -> DataFrame:
    """``corpus`` with ``sentiment``, the model's ``label`` and ``score``, and ``error``.

    Texts are cut before they leave the JVM; label mapping happens after they
    return. The model is given texts of similar length, at most ``batch_chars``
    characters at once. Blank texts and failures score 0.0. No shuffle.
    """
    predict = _prediction_udf(predictor_factory, batch_chars)
    scored = corpus.withColumn("_prediction", predict(truncate_text(text, max_chars)))
    polarity = label_to_polarity("_prediction.label", "_prediction.score")
    return scored.withColumns(
        {
            "label": F.col("_prediction.label"),
            "score": F.col("_prediction.score"),
            "error": F.col("_prediction.error"),
            "sentiment": F.coalesce(polarity, F.lit(0.0)),
        }
    ).drop("_prediction")
