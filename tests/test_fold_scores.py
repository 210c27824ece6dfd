"""Thresholds score and read only the held-out side of the folds."""

import pytest
from pyspark.sql import functions as F

from tenura.operators import models


class ByTenths:
    """Scores a row by its id."""

    def __init__(self, scored):
        self.scored = scored

    def score(self, df, keep=()):
        self.scored.append(df.count())
        prob = (F.col("row_id") % 10) / 10.0
        return df.select("row_id", F.col("label").cast("int").alias("label"), prob.alias("prob"), (prob > 0.5).cast("int").alias("pred"), *keep)


@pytest.fixture
def train(spark):
    return spark.range(200).select(F.col("id").alias("row_id"), ((F.col("id") % 10 > 5) != (F.col("id") % 7 == 0)).cast("int").alias("label"))


def test_thresholds_score_each_row_once_and_build_no_summary(train, monkeypatch, rows):
    scored, whole = [], []
    want = models.validate(train, lambda _: ByTenths(whole), 4)[0]
    monkeypatch.setattr(models, "fold_metrics", lambda *a, **k: pytest.fail("no summary is asked for"))
    found = models.select_thresholds(train, lambda _: ByTenths(scored), 4)
    assert sum(scored) == 200 and sum(whole) == 800
    assert rows(found) == rows(want) and found.first()["selection_source"] == "out_of_fold"


def test_one_side_is_that_of_both(train, rows):
    both, test = (models.out_of_fold(train, lambda _: ByTenths([]), 3, **more) for more in ({}, {"parts": ("test",)}))
    assert rows(test) == rows(both.where("part = 'test'")) and test.count() == 200
