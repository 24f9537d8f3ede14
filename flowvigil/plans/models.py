"""Fitted models on a shared file system, and how well they do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    """Fails if there is a model already, unless it may be replaced."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


class ModelFeed:
    """The newest model of a table of versions (``version, location``).

    ``read`` opens the table anew at each call; a model is loaded when its version
    is the newest for the first time. Rows without a location are not ready yet
    and are passed over.
    """

    def __init__(self, read: Callable[[], DataFrame]) -> None:
        self._read = read
        self._seen: tuple | None = None
        self._model: PipelineModel | None = None

    def __call__(self) -> tuple[int, PipelineModel]:
        ready = self._read().where("version is not null and location is not null")
        newest = ready.orderBy(F.desc("version"), F.desc("location")).select("version", "location").head()
        if newest is None:
            raise ValueError("the table of model versions is empty")
        if tuple(newest) != self._seen:
            self._model, self._seen = load_model(newest["location"]), tuple(newest)
        return newest["version"], self._model


def confusion(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per pair of given and predicted label."""
    return scored.groupBy(label, predicted).count()


def evaluate(scored: DataFrame, prediction: str = "prediction", metric: str = "f1") -> float:
    evaluator = MulticlassClassificationEvaluator(
        labelCol="indexedLabel", predictionCol=prediction, metricName=metric
    )
    return evaluator.evaluate(scored)
