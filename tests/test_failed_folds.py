"""A fold that fails is a failure of the thresholds, not thresholds of less work."""

import pytest
from pyspark.sql import functions as F

from tenura.operators import models
from tenura.plans import queries


@pytest.fixture
def train(spark):
    return spark.range(60).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))


def failing_once(fits):
    """A fit that fails the first time, as one lost fold does, and would do for an inner split."""

    class Scorer:
        def score(self, df, keep=()):
            return df.select("row_id", F.col("label").cast("int").alias("label"), F.lit(0.5).alias("prob"), F.lit(1).alias("pred"), *keep)

    def fit(*_):
        fits.append(1)
        if len(fits) == 1:
            raise RuntimeError("a fold failed")
        return Scorer()

    return fit


@pytest.mark.parametrize("summary", [True, False])
def test_a_failed_fold_fails_the_validation(train, summary):
    with pytest.raises(RuntimeError, match="a fold failed"):
        models.validate(train, failing_once([]), 2, summary=summary)
    best, none = models.validate(train, failing_once([]), 2, summary=summary, fallback=True)
    assert best.first()["selection_source"] == "inner_split" and none is None


def test_the_query_does_not_fall_back(train, monkeypatch):
    monkeypatch.setattr(queries, "_parts", lambda *_: (train, train, "columns"))
    monkeypatch.setattr(models, "fit_linear", failing_once([]))
    with pytest.raises(RuntimeError, match="a fold failed"):
        queries.QUERIES["oof_thresholds"](None, "")
