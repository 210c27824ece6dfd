import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tenura.operators import ranking, splitting


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one score; the rest is spread with ties."""
    x = F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % 997) / 997.0)
    return spark.range(3000).select(F.col("id").alias("row_id"), x.alias("score"), (F.col("id") % 5 == 0).cast("bigint").alias("y")).cache()


@pytest.mark.parametrize("buckets", [2, 8, 200])
def test_rank_matches_plain_window(skewed, rows, buckets):
    w = Window.orderBy(F.desc("score"), "row_id")
    want = skewed.select("row_id", F.row_number().over(w).alias("rank"), F.sum("y").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("u"))
    got = ranking.rank_rows(skewed, "score", "row_id", ["y"], buckets=buckets).select("row_id", "rank", "y_upto")
    assert rows(got) == rows(want)


def test_rank_ignores_partitioning(skewed, rows):
    a = ranking.rank_rows(skewed.repartition(1), "score", "row_id").select("row_id", "rank")
    b = ranking.rank_rows(skewed.repartition(64), "score", "row_id").select("row_id", "rank")
    assert rows(a) == rows(b)


def test_hot_score_is_split(skewed, spark):
    ranked = ranking.rank_rows(skewed, "score", "row_id", buckets=16)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" in plan
    points = ranking.split_points(skewed, ["score"], 16)["score"]
    assert any(points.hot) and points.edges[points.hot.index(True)] == 0.5


def test_value_cells_and_quantiles(skewed, rows):
    cells = ranking.value_cells(skewed, ["score"], "y", buckets=8)
    pdf = skewed.toPandas()
    total = {r["value"]: (r["n"], r["n_before"], r["pos_before"]) for r in cells.collect()}
    assert total[0.5] == ((pdf.score == 0.5).sum(), (pdf.score < 0.5).sum(), pdf.y[pdf.score < 0.5].sum())
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["q"]: r["quantile"] for r in ranking.quantiles_from_cells(cells, ["series"], probabilities).collect()}
    assert np.allclose([got[q] for q in probabilities], np.quantile(pdf.score, probabilities), rtol=1e-12)


def test_even_count_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    cells = ranking.value_cells(df, ["x"])
    assert ranking.quantiles_from_cells(cells, ["series"], [0.5]).first()["quantile"] == 2.5


def test_constant_null_and_nan_columns(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (1.0, None, 2.0)], "a double, b double, c double")
    got = {(r["series"], r["value"]): r["n"] for r in ranking.value_cells(df, ["a", "b", "c"]).collect()}
    assert got == {("a", 1.0): 2, ("c", 2.0): 1}


def test_split_is_exact_and_stable(skewed, rows):
    first = splitting.stratified_split(skewed, label="y")
    assert rows(first, "row_id", "part") == rows(splitting.stratified_split(skewed.repartition(17), label="y"), "row_id", "part")
    sizes = {(r["y"], r["part"]): r["count"] for r in first.groupBy("y", "part").count().collect()}
    assert sizes == {(0, "test"): 480, (0, "train"): 1920, (1, "test"): 120, (1, "train"): 480}
    folds = splitting.stratified_folds(skewed, 5, label="y").groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds if r["y"] == 1} == {120} and len(folds) == 10


def test_no_row_level_single_partition(skewed):
    for df in (
        ranking.rank_rows(skewed, "score", "row_id", ["y"]),
        ranking.value_cells(skewed, ["score"], "y"),
        splitting.stratified_split(skewed, label="y"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The only single task orders the bucket totals, which were summed just before.
        for chunk in plan.split("Exchange SinglePartition")[1:]:
            assert "HashAggregate" in chunk.split("Exchange")[0]


def test_extreme_values_are_ordered(spark):
    values = [float("-inf"), -1e-300, 0.0, 1e-5, 5e300, float("inf")] * 4
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_id bigint, x double")
    got = [r["x"] for r in ranking.rank_rows(df, "x", "row_id", descending=False, buckets=8).orderBy("rank").collect()]
    assert got == sorted(values)
