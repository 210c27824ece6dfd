"""Writing prepared tables, reports, predictions, models and the run log."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

from tenura.operators.cleaning import normalise_categories
from tenura.roles import Roles

LOG = logging.getLogger(__name__)
RUN_SCHEMA = (
    "run_id string, parent_run_id string, run_name string, kind string, key string, "
    "str_value string, num_value double, logged_at timestamp"
)


def write_prepared(df: DataFrame, roles: Roles, path: str, *, normalised: bool = False) -> None:
    """The prepared table as Parquet with its roles; ``normalised`` trims and upper-cases categories."""
    table = normalise_categories(df, roles.categories(df)) if normalised else df
    table.write.mode("overwrite").parquet(f"{path}/table")
    spark = df.sparkSession
    spark.createDataFrame([(roles.to_json(),)], "roles string").coalesce(1).write.mode("overwrite").json(f"{path}/roles")


def write_report(report: DataFrame, path: str) -> None:
    """A one-row nested report as a single JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions in descending probability, then by row id, which is not written; the range sort keeps part files in order."""
    ties = [c for c in ("row_id",) if c in predictions.columns]
    predictions.orderBy(F.desc("churn_probability"), *ties).drop(*ties).write.mode("overwrite").option("header", True).csv(path)


def write_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


class RunLog:
    """Append-only experiment log; a failing write is reported and never stops the run."""

    def __init__(self, spark: SparkSession, path: str, run_name: str, parent: "RunLog | None" = None):
        self.spark, self.path, self.run_name = spark, path, run_name
        self.run_id = uuid.uuid4().hex
        self.parent_id = parent.run_id if parent else None

    def log(self, kind: str, values: dict[str, object]) -> None:
        """``kind`` is param, metric, tag or artifact."""
        now = datetime.now(timezone.utc)
        rows = []
        for key, value in values.items():
            is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
            rows.append(
                (self.run_id, self.parent_id, self.run_name, kind, key, str(value), float(value) if is_number else None, now)
            )
        try:
            self.spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as failure:  # noqa: BLE001 - the log is optional
            LOG.warning("run log not written: %s", failure)

    def child(self, run_name: str) -> "RunLog":
        return RunLog(self.spark, self.path, run_name, self)
