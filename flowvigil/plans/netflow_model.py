"""Train and apply the conversation classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    Imputer,
    IndexToString,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowvigil.operators.features import FEATURE_COLUMNS


@dataclass(frozen=True)
class NetflowModelSettings:
    """``training_partitions`` spreads the training rows; None leaves it to Spark.

    ``impute`` puts the mean in place of a missing feature, such as the packets of
    a conversation whose records all lack a count. Without it such a conversation
    fails the job.
    """

    max_categories: int = 3
    tree_depth: int = 4
    trees: int = 500
    training_partitions: int | None = 300
    impute: bool = True
    unseen_category: str = "keep"
    seed: int = 42


def conversation_classifier(settings: NetflowModelSettings, labels: list[str]) -> Pipeline:
    columns = list(FEATURE_COLUMNS)
    stages = []
    if settings.impute:
        imputed = [f"{column}_imputed" for column in columns]
        stages.append(Imputer(inputCols=columns, outputCols=imputed, strategy="mean"))
        columns = imputed
    stages += [
        VectorAssembler(inputCols=columns, outputCol="features"),
        StringIndexer(inputCol="label", outputCol="indexedLabel"),
        VectorIndexer(
            inputCol="features",
            outputCol="indexedFeatures",
            maxCategories=settings.max_categories,
            handleInvalid=settings.unseen_category,
        ),
        RandomForestClassifier(
            labelCol="indexedLabel",
            featuresCol="indexedFeatures",
            maxDepth=settings.tree_depth,
            numTrees=settings.trees,
            seed=settings.seed,
        ),
        IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=labels),
    ]
    return Pipeline(stages=stages)


def train_netflow_model(
    features: DataFrame, settings: NetflowModelSettings | None = None
) -> PipelineModel:
    settings = settings or NetflowModelSettings()
    rows = features.select(
        *[F.col(column).cast("double").alias(column) for column in FEATURE_COLUMNS], "label"
    )
    if settings.training_partitions is not None:
        rows = rows.repartition(settings.training_partitions)
    stored = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        labels = StringIndexer(inputCol="label", outputCol="indexedLabel").fit(stored).labels
        return conversation_classifier(settings, list(labels)).fit(stored)
    finally:
        stored.unpersist()
