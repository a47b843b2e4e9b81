"""Models by name, beside the tables: train, evaluate, predict, explain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from . import explain, models


class Workbench:
    """A folder of named models; training under a used name replaces that model."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or f"{shared_dir(spark)}/tabsift/models").rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def create_model(self, name: str, df: DataFrame, model_type: str, label: str | None = None, **options) -> models.Model:
        model = models.train(df, model_type, label, **options)
        model.save(self.spark, self._path(name))
        return model

    def load(self, name: str) -> models.Model:
        return models.Model.load(self.spark, self._path(name))

    def evaluate(self, name: str, df: DataFrame | None = None, threshold: float | None = None) -> DataFrame:
        """Metrics of the stored hold-out, or of the rows given."""
        model = self.load(name)
        if df is not None:
            return models.evaluate(model, df, threshold)
        cols = ", ".join(f"{k} double" for k in model.metrics)
        return self.spark.createDataFrame([tuple(model.metrics.values())], cols)

    def predict(self, name: str, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return models.predict(self.load(name), df, threshold)

    def confusion_matrix(self, name: str, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return models.confusion(self.load(name), df, threshold)

    def global_explain(self, name: str) -> DataFrame:
        return explain.global_explain(self.load(name), self.spark)
