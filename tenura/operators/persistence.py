"""Fitted models as files: one Spark ML pipeline of a preparation stage and the learner.

The preparation stage carries everything that was fitted before the learner: columns, dropped columns, medians, spreads,
sentinels and bins as metadata, encodings and category bins as Parquet tables. A pipeline that is read back scores rows
as the model did that wrote it.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from tenura.operators.models import BoostedModel, Columns, LinearModel


class Preparation(Transformer, MLWritable, MLReadable):
    """Raw prepared rows to the learner's feature vector."""

    def __init__(self, fitted: LinearModel | BoostedModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.prepare(dataset)

    def write(self) -> MLWriter:
        return PreparationWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return PreparationReader()


class PreparationWriter(MLWriter):
    def __init__(self, stage: Preparation):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        fitted = self.stage.fitted
        state = {"columns": asdict(fitted.columns), "inputs": fitted.inputs}
        if isinstance(fitted, LinearModel):
            table = fitted.encoding
            state |= {"kind": "linear", "dropped": fitted.dropped, "medians": fitted.medians, "scaling": fitted.scaling}
        else:
            table = fitted.bins
            state |= {"kind": "boosted", "sentinels": fitted.sentinels, "unseen": fitted.unseen}
        state["has_table"] = table is not None
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"fitted": state})
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/categories")


class PreparationReader(MLReader):
    def load(self, path: str) -> Preparation:
        state = DefaultParamsReader.loadMetadata(path, self.sparkSession)["fitted"]
        columns = Columns(**{k: tuple(v) if isinstance(v, list) else v for k, v in state["columns"].items()})
        table = self.sparkSession.read.parquet(f"{path}/categories") if state["has_table"] else None
        if state["kind"] == "linear":
            scaling = {c: (m, s) for c, (m, s) in state["scaling"].items()}
            fitted = LinearModel(columns, state["dropped"], table, state["medians"], scaling, None, state["inputs"])
        else:
            fitted = BoostedModel(columns, state["sentinels"], table, state["unseen"], None, state["inputs"])
        return Preparation(fitted)


def pipeline(fitted: LinearModel | BoostedModel) -> PipelineModel:
    """Preparation and learner as one Spark ML model."""
    return PipelineModel([Preparation(fitted), fitted.model])


def load_model(spark: SparkSession, path: str) -> LinearModel | BoostedModel:
    """A model written by ``write_model(pipeline(fitted), path)``, ready to score and to explain."""
    preparation, learner = PipelineModel.load(path).stages
    preparation.fitted.model = learner
    return preparation.fitted
