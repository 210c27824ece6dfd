"""One-row nested reports assembled from operator results, ready for the JSON sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenura.functions.expressions import calibration_note, discrimination_band, safe_div
from tenura.operators.cleaning import missing_counts
from tenura.operators.correlation import correlation_with_target, top_correlated
from tenura.operators.profiling import cardinality, duplicate_rows
from tenura.operators.segments import SEGMENT_PERCENTS
from tenura.roles import FLAG_SUFFIX, Roles


def gathered(rows: DataFrame, order: list[Column | str]) -> Column:
    """A report table (bounded: one row per column, metric or grid point) as an array of structs."""
    keyed = F.struct(*[c.alias(f"k{i}") if isinstance(c, Column) else F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    items = F.array_sort(F.collect_list(F.struct(keyed.alias("k"), F.struct(*rows.columns).alias("v"))))
    return rows.agg(F.transform(items, lambda i: i["v"]).alias("items")).scalar()


def one_row(table: DataFrame) -> Column:
    """A one-row table as a struct column."""
    return table.agg(F.first(F.struct(*table.columns)).alias("row")).scalar()


def _report(df: DataFrame, base: list[Column], parts: dict[str, Column]) -> DataFrame:
    return df.agg(*base).select("*", *[c.alias(n) for n, c in parts.items()])


def _class_counts(label: str) -> list[Column]:
    y = F.col(label)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.bround(F.avg(y.cast("double")), 4).alias("churn_rate"),
        F.count_if(y == 1).alias("churn_count"),
        F.count_if(y == 0).alias("no_churn_count"),
    ]


def preparation_report(raw: DataFrame, prepared: DataFrame, decisions: dict, roles: Roles, engineered: list[str]) -> DataFrame:
    """What the preparation did: shape, classes, duplicates, dropped and added columns, missing shares."""
    features = [c for c in prepared.columns if c not in (roles.row_id, roles.target)]
    missing = (
        missing_counts(prepared, features)
        .where(F.col("n_missing") > 0)
        .select("column", F.bround(F.col("missing_rate") * 100, 2).alias("missing_pct"))
    )
    texts = lambda names: F.lit(list(names)) if names else F.array().cast("array<string>")
    numeric = [c for c in roles.numeric(prepared) if c in features]
    return _report(
        prepared,
        _class_counts(roles.target),
        {
            "n_columns": F.lit(len(features)),
            "duplicate_row_count": duplicate_rows(raw).select("n_duplicates").scalar(),
            "dropped_columns": texts(decisions["sparse"]),
            "dropped_identifier_columns": texts(decisions.get("identifiers", [])),
            "dropped_high_missing_columns": texts(decisions["sparse"]),
            "undeclared_text_columns": texts(decisions.get("undeclared", [])),
            "was_missing_flags": texts([c for c in features if c.endswith(FLAG_SUFFIX)]),
            "engineered_features": texts([c for c in engineered if c in features]),
            "missing_value_summary": gathered(missing, [F.col("missing_pct") * -1, "column"]),
            "final_feature_count": F.lit(len(features)),
            "categorical_feature_count": F.lit(len([c for c in roles.categorical if c in features])),
            "binary_cat_feature_count": F.lit(len([c for c in roles.binary if c in features])),
            "numeric_feature_count": F.lit(len(numeric)),
        },
    )


def profile_summary(df: DataFrame, roles: Roles, exclude: list[str] | None = None) -> DataFrame:
    """Shape, classes, duplicates, strongest correlations, missing shares, cardinalities."""
    features = [c for c in df.columns if c not in (roles.row_id, roles.target)]
    correlations = top_correlated(correlation_with_target(df, roles.numeric(df), roles.target), 10)
    missing = (
        missing_counts(df, features)
        .select("column", F.bround(F.col("missing_rate") * 100, 1).alias("missing_pct"))
        .where(F.col("missing_pct") > 0)
    )
    return _report(
        df,
        _class_counts(roles.target),
        {
            "n_cols": F.lit(len(features) + 1),
            "duplicate_row_count": duplicate_rows(df, exclude).select("n_duplicates").scalar(),
            "top_10_corr_with_churn": gathered(
                correlations.select("series", F.bround("r", 4).alias("r")), [F.abs("r") * -1, "series"]
            ),
            "missing_pct": gathered(missing, [F.col("missing_pct") * -1, "column"]),
            "categorical_cardinality": gathered(
                cardinality(df, roles.categories(df)), [F.col("n_values") * -1, "feature"]
            ),
        },
    )


def business_interpretation(matrix: DataFrame) -> DataFrame:
    """Caught, missed and false alarms in words of the campaign, percentages to one digit."""
    return matrix.select(
        "series",
        F.col("tp").alias("churners_caught"), F.col("fn").alias("churners_missed"), F.col("fp").alias("false_alarms"),
        F.bround(safe_div(F.col("tp"), F.col("tp") + F.col("fn")) * 100, 1).alias("catch_rate_pct"),
        F.bround(safe_div(F.col("tp"), F.col("tp") + F.col("fp")) * 100, 1).alias("precision_pct"),
    )


def kpi_row(intervals: DataFrame, segment_table: DataFrame, thresholds: DataFrame, business: DataFrame) -> DataFrame:
    """AUC with interval and band, top-20 capture and lift, threshold, precision, recall - one row.

    ``business`` is the one-row point-metric table at the business threshold.
    """
    auc_row = intervals.where(F.col("metric") == "auc_roc")
    top = segment_table.where(F.col("percent") == 20)
    return auc_row.select(
        F.col("mean").alias("auc"), "ci_low", "ci_high", discrimination_band(F.col("mean")).alias("band"),
        top.select("churn_captured_pct").scalar().alias("top_20_capture_pct"),
        (top.select("churn_captured_pct").scalar() / 20.0).alias("top_20_lift"),
        thresholds.select("business_threshold").scalar().alias("business_threshold"),
        business.select("precision").scalar().alias("precision_business"),
        business.select("recall").scalar().alias("recall_business"),
    )


#: What readers of the evaluation report call the metrics.
METRIC_FIELDS = {"auc_roc": "AUC-ROC", "f1": "F1", "precision": "Precision", "recall": "Recall", "avg_precision": "Avg Prec"}


def segmentation_report(segment_table: DataFrame, gain: DataFrame, percents: tuple[int, ...] = SEGMENT_PERCENTS) -> DataFrame:
    """One row: a ``top_<p>_percent`` section for every segment and the points of the gain curve."""
    section = F.struct("n_customers", "churn_rate_pct", "churn_captured_pct")
    sections = [F.max(F.when(F.col("percent") == p, section)).alias(f"top_{p}_percent") for p in percents]
    return segment_table.agg(*sections).withColumn("gain_curve_data", gathered(gain, ["customer_pct"]))


def evaluation_report(
    scored: DataFrame,
    model_name: str,
    *,
    intervals: DataFrame,
    calibration: DataFrame,
    matrix: DataFrame,
    thresholds: DataFrame,
    matrix_business: DataFrame,
    segment_table: DataFrame,
    gain: DataFrame,
) -> DataFrame:
    """The final nested report of one model under its readers' field names; every input is a small report table."""
    ece = calibration.select("approx_ece").scalar()
    interval = F.struct(*[F.bround(F.col(c), 4).alias(c) for c in ("mean", "ci_low", "ci_high")])
    named = intervals.agg(*[F.max(F.when(F.col("metric") == m, interval)).alias(n) for m, n in METRIC_FIELDS.items()])
    words = {"churners_caught": "churners_caught_tp", "churners_missed": "churners_missed_fn", "false_alarms": "false_alarms_fp", "catch_rate_pct": "catch_rate_recall_pct"}
    at_business = [F.bround(F.col(c), 4).alias(f"{c}_business") for c in ("precision", "recall", "f1")]
    cut = thresholds.select("business_threshold").scalar()
    return scored.agg(F.count(F.lit(1)).alias("n_test_samples")).select(
        F.lit(model_name).alias("model"), "n_test_samples", F.lit(0.5).alias("threshold_used"),
        one_row(named).alias("metrics"),
        F.bround(ece, 4).alias("calibration_approx_ece"),
        F.bround(calibration.select("weighted_ece").scalar(), 4).alias("calibration_weighted_ece"),
        calibration_note(ece).alias("calibration_note"),
        one_row(matrix.select("tn", "fp", "fn", "tp")).alias("confusion_matrix"),
        one_row(business_interpretation(matrix).drop("series").withColumnsRenamed(words)).alias("business_interpretation_at_threshold_0_5"),
        one_row(thresholds).alias("threshold_optimization"),
        one_row(segmentation_report(segment_table, gain)).alias("business_segmentation"),
        one_row(matrix_business.select("tn", "fp", "fn", "tp")).alias("confusion_matrix_business_threshold"),
        one_row(matrix_business.select(cut.alias("threshold"), *at_business)).alias("business_threshold_metrics"),
    )
