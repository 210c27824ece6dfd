import pytest
from pyspark.sql import functions as F

from tenura.operators import models, persistence
from tenura.operators.features import UsageColumns
from tenura.plans import tables, workflow
from tenura.roles import Roles
from tenura.sources import readers, writers


def test_delimited_scan(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a;b;churn\n1,5;NA;0\nn/a;x;1\n;null;1\n")
    df = readers.read_delimited(spark, str(tmp_path / "in.csv"))
    assert [tuple(r) for r in df.collect()] == [("1,5", None, "0"), (None, "x", "1"), (None, None, "1")]


@pytest.mark.parametrize(
    "rows,target,words",
    [([], "churn", "no rows"), ([(1,)], "gone", "absent"), ([(None,), (1,)], "churn", "no target"), ([(1,), (1,)], "churn", "two classes")],
)
def test_source_validation(spark, rows, target, words):
    with pytest.raises(ValueError, match=words):
        readers.require_valid_source(spark.createDataFrame(rows, "churn int"), target)


def test_missing_output_reads_empty(spark, tmp_path):
    assert readers.read_or_empty(spark, str(tmp_path / "no"), "csv", readers.PREDICTION_SCHEMA).count() == 0


def test_reports_of_other_versions_read_with_empty_sections(spark, tmp_path):
    assert readers.read_evaluation(spark, str(tmp_path / "none")).count() == 0
    spark.createDataFrame([("old", 5, "x")], "model string, n_test_samples int, unknown string").coalesce(1).write.json(str(tmp_path / "old"))
    old = readers.read_evaluation(spark, str(tmp_path / "old")).first()
    assert old["model"] == "old" and old["n_test_samples"] == 5 and old["metrics"] is None and old["business_segmentation"] is None


def test_prepared_round_trip_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", 0)], "row_id int, area string, churn int")
    writers.write_prepared(df, Roles(), str(tmp_path / "p"), normalised=True)
    table, roles = readers.read_prepared(spark, str(tmp_path / "p"))
    assert table.first()["area"] == "A" and roles == Roles()
    report = df.select(F.struct("row_id", F.array("area").alias("names")).alias("nested"))
    writers.write_report(report, str(tmp_path / "r"))
    assert readers.read_report(spark, str(tmp_path / "r")).first()["nested"]["names"] == [" a "]


def test_run_log_never_blocks(spark, tmp_path):
    log = writers.RunLog(spark, str(tmp_path / "runs"), "top")
    log.log("metric", {"auc": 0.7})
    log.child("trial").log("param", {"depth": 3, "kind": "x"})
    got = spark.read.parquet(str(tmp_path / "runs"))
    assert {(r["key"], r["num_value"], r["parent_run_id"] == log.run_id) for r in got.collect()} == {
        ("auc", 0.7, False), ("depth", 3.0, True), ("kind", None, True)}
    writers.RunLog(spark, "nosuchscheme://x", "broken").log("tag", {"a": "b"})


def test_both_runs_end_to_end(spark, tmp_path, tiny):
    """Delimited text in, every output out."""
    base = tables.customer_base(spark, tiny).where(F.col("area").isNotNull())
    comma = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    text = base.select(
        F.concat(F.lit("C"), F.col("row_id").cast("string")).alias("Customer_ID"),
        *[comma(c).alias(c) for c in tables.BASE_NUMERIC], "area", F.col("segment").alias("ethnic"),
        F.col("label").cast("string").alias("churn"),
    )
    source, output = str(tmp_path / "in"), str(tmp_path / "out")
    text.write.option("sep", ";").option("header", True).csv(source)
    usage = UsageColumns("avg6", "avg12", "returned", "placed", "idle_days", "recent_usage_delta")
    quick = models.BoostedParams(n_trees=3, max_depth=2, learning_rate=0.3, min_child_samples=5)
    settings = workflow.Settings(
        source, output, usage=usage, boosted=quick, trials=1, folds=2, metric_replicates=12,
        difference_replicates=12, explain_rows=20,
    )
    profile = workflow.profile(spark, settings).first()
    assert profile["n_rows"] == 150 and len(profile["top_10_corr_with_churn"]) > 3
    final = workflow.run(spark, settings).first()
    assert final["n_test_samples"] == 30 or final["n_test_samples"] == 31
    assert set(final["metrics"].asDict()) == {"AUC-ROC", "F1", "Precision", "Recall", "Avg Prec"}
    read = readers.read_evaluation(spark, f"{output}/final_evaluation").first()
    assert read["metrics"]["AUC-ROC"]["ci_low"] <= read["metrics"]["AUC-ROC"]["mean"] <= read["metrics"]["AUC-ROC"]["ci_high"]
    assert read["business_threshold_metrics"]["threshold"] == read["threshold_optimization"]["business_threshold"]
    parts = readers.read_segmentation(spark, f"{output}/business_segmentation").first()
    assert parts == read["business_segmentation"] and parts["top_20_percent"]["churn_captured_pct"] is not None
    assert len(parts["gain_curve_data"]) == final["n_test_samples"]
    prep = readers.read_report(spark, f"{output}/preparation_report").first()
    assert prep["dropped_identifier_columns"] == ["Customer_ID"] and prep["dropped_columns"] == ["avg3"]
    assert prep["undeclared_text_columns"] == []
    quality = {r["column"]: r for r in readers.read_report(spark, f"{output}/parse_quality").collect()}
    assert set(quality) == set(tables.BASE_NUMERIC) and not any(r["warn"] for r in quality.values())
    assert readers.read_report(spark, f"{output}/rule_violations").count() == 0  # no column of these rules is there
    agreement = readers.read_report(spark, f"{output}/importance_agreement").first()
    assert agreement["n"] == len(agreement["pairs"]) and 0 <= agreement["p_value"] <= 1 and abs(agreement["rho"]) <= 1
    predictions = readers.read_predictions(spark, f"{output}/predictions")
    assert predictions.count() == final["n_test_samples"]
    drivers = readers.read_report(spark, f"{output}/top_churn_drivers")
    assert drivers.count() == 20 and len(drivers.first()["top_drivers"]) == 3
    choice = readers.read_report(spark, f"{output}/model_selection_report").first()
    assert choice["winner"] == choice["selected_model"] == final["model"]
    # both models were written and score the hold-out as they did
    prepared, _ = readers.read_prepared(spark, f"{output}/prepared")
    for name in ("logistic_regression", "gradient_boosted_trees"):
        model = persistence.load_model(spark, f"{output}/models/{name}")
        scored = spark.read.parquet(f"{output}/scores/{name}")
        ids = scored.select(Roles().row_id)
        again = model.score(prepared.join(ids, Roles().row_id, "left_semi"))
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))
        weights = readers.read_report(spark, f"{output}/model_weights/{name}")
        assert {r["feature"] for r in weights.collect()} == set(model.inputs)
        folds = readers.read_report(spark, f"{output}/cross_validation/{name}")
        assert {(r["metric"], r["part"]) for r in folds.collect()} == {(m, p) for m in ("roc_auc", "f1", "precision", "recall") for p in ("train", "test")}
