"""The linear fit orders only the values near the quartiles and deals its encoder folds once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import encoding, models, ranking


@pytest.fixture(scope="module")
def measures(spark):
    rng = np.random.default_rng(5)
    rows = [
        (i, float(rng.normal()) if i % 3 else None, float(rng.integers(0, 4)), float(rng.lognormal()) if i % 11 == 0 else None,
         float("nan") if i % 5 == 0 else float(i % 400), None, float(rng.normal()) if i == 17 else None)
        for i in range(2_000)
    ]
    schema = "row_id bigint, third_gone double, ties double, mostly_gone double, nan double, nothing double, one double"
    return spark.createDataFrame(rows, schema).persist()


def test_quartiles_after_imputation_without_ordering_all_values(measures, monkeypatch):
    monkeypatch.setattr(encoding, "value_cells", lambda *a, **k: pytest.fail("all values were ordered"))
    columns = measures.columns[1:]
    medians, scaling = encoding.fit_after_imputation(measures, columns)
    for c in columns:
        known = np.array([np.nan if r[0] is None else r[0] for r in measures.select(c).collect()], float)
        middle = float(np.median(known[~np.isnan(known)])) if (~np.isnan(known)).any() else 0.0
        assert medians[c] == pytest.approx(middle)
        if c == "nothing":
            continue
        low, centre, high = np.quantile(np.where(np.isnan(known), middle, known), [0.25, 0.5, 0.75])
        assert scaling[c] == pytest.approx((centre, high - low or 1.0))


def test_cells_at_ranks_are_the_same_cells_but_few(measures):
    every = {tuple(r) for r in ranking.value_cells(measures, ["third_gone"]).select("series", "value", "n", "n_before", "n_total").collect()}
    some = {tuple(r) for r in ranking.cells_at_ranks(measures, ["third_gone"], lambda n: F.array(F.lit(0).cast("bigint"), n - 1, n + 5)).collect()}
    assert some < every and len(some) < len(every) / 4
    assert {min(every, key=lambda c: c[1]), max(every, key=lambda c: c[1])} <= some


def test_encoder_folds_are_dealt_once(spark, monkeypatch):
    train = spark.range(200).select(
        F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 5).cast("string").alias("c"),
    )
    seen, crossfit = [], models.crossfit_encoding
    monkeypatch.setattr(models, "crossfit_encoding", lambda df, *a: seen.append(df) or crossfit(df, *a))
    models.fit_linear(train, models.Columns(("x",), ("c",)))
    assert "Window" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
