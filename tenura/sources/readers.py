"""Reading customer tables, scored rows and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenura.functions.expressions import missing_to_null
from tenura.operators.profiling import source_checks
from tenura.operators.segments import SEGMENT_PERCENTS
from tenura.roles import Roles

PREDICTION_SCHEMA = (
    "churn_probability double, prediction_0_5 int, prediction_best_f1 int, prediction_business int, true_label int"
)


def read_delimited(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Every column as text with the usual missing-value tokens as NULL; typing is explicit later."""
    raw = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION_SCHEMA).option("header", True).csv(path)


def read_prepared(spark: SparkSession, path: str) -> tuple[DataFrame, Roles]:
    """A prepared table and the column roles stored beside it."""
    roles = spark.read.json(f"{path}/roles").first()["roles"]
    return spark.read.parquet(f"{path}/table"), Roles.from_json(roles)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


_SECTION = "struct<n_customers: bigint, churn_rate_pct: double, churn_captured_pct: double>"
_INTERVAL = "struct<mean: double, ci_low: double, ci_high: double>"
_COUNTS = "struct<tn: bigint, fp: bigint, fn: bigint, tp: bigint>"
SEGMENTATION_SCHEMA = ", ".join(
    [f"top_{p}_percent {_SECTION}" for p in SEGMENT_PERCENTS]
    + ["gain_curve_data array<struct<customer_pct: double, churners_captured_pct: double>>"]
)
EVALUATION_SCHEMA = (
    "model string, n_test_samples bigint, threshold_used double, "
    f"metrics struct<`AUC-ROC`: {_INTERVAL}, F1: {_INTERVAL}, Precision: {_INTERVAL}, Recall: {_INTERVAL}, `Avg Prec`: {_INTERVAL}>, "
    "calibration_approx_ece double, calibration_weighted_ece double, calibration_note string, "
    f"confusion_matrix {_COUNTS}, "
    "threshold_optimization struct<best_f1_threshold: double, business_threshold: double>, "
    "business_segmentation struct<" + SEGMENTATION_SCHEMA.replace("_percent struct", "_percent: struct").replace("gain_curve_data array", "gain_curve_data: array") + ">, "
    f"confusion_matrix_business_threshold {_COUNTS}, "
    "business_threshold_metrics struct<threshold: double, precision_business: double, recall_business: double, f1_business: double>"
)


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """The evaluation report; sections that the file does not have are NULL, and no file is an empty table."""
    return read_or_empty(spark, path, "json", EVALUATION_SCHEMA)


def read_segmentation(spark: SparkSession, path: str) -> DataFrame:
    """The segmentation report, as tolerant as ``read_evaluation``."""
    return read_or_empty(spark, path, "json", SEGMENTATION_SCHEMA)


def read_or_empty(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType) -> DataFrame:
    """An output that is not there yet reads as an empty table of its schema."""
    try:
        return spark.read.schema(schema).format(fmt).option("header", True).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def require_valid_source(df: DataFrame, target: str) -> None:
    """Non-empty, target present and never NULL, at least two classes; else ``ValueError``."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is absent")
    found = source_checks(df, target).first()
    if found["n_rows"] == 0:
        raise ValueError("the source has no rows")
    if found["n_null_target"] > 0:
        raise ValueError(f"{found['n_null_target']} rows have no target")
    if found["n_classes"] < 2:
        raise ValueError("the target has fewer than two classes")
