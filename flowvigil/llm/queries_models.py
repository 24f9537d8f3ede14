"""op2 and op4: trained models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.llm.language import language, train_language_model
from flowvigil.llm.registry import query, table
from flowvigil.llm.toxicity import toxicity_score, train_toxicity


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document, by its id as text."""
    return F.crc32(doc_id.cast("string")) % folds


@query("op2_language")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train_language_model(documents.where(~held_out))
    judged = documents.select(
        "doc_id", held_out.alias("held_out"), language(F.col("text"), model).alias("judged")
    )
    return judged.select(
        "doc_id", "held_out", F.col("judged.lang").alias("lang_pred"), F.col("judged.score").alias("score")
    )


@query("op4_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = train_toxicity(documents, labels.where(fold(F.col("doc_id"), 5) != 0))
    scored = documents.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        toxicity_score(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
