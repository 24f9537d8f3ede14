"""Stored documents as variants: every key with the type it was written with.

``records_of`` and ``flows_of`` know the columns they read. Here nothing has to be
known: a document is parsed once into a variant, whose keys can be listed with
their types, and read as columns of any type. What does not parse is null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def variant_documents(table: DataFrame, document: str = "document", name: str = "doc") -> DataFrame:
    """Add the document as a variant; null where it is null or no JSON."""
    return table.withColumn(name, F.try_parse_json(F.col(document)))


def variant_path(key: str) -> str:
    """The path of a top-level key, whatever signs are in it."""
    if '"' not in key:
        return f'$["{key}"]'
    if "'" not in key:
        return f"$['{key}']"
    raise ValueError(f"no path can name a key with both quotation marks: {key!r}")


def variant_columns(wanted: Mapping[str, str], doc: str = "doc") -> list[Column]:
    """Keys as columns of a type each; null where a value is absent or does not fit."""
    return [
        F.try_variant_get(F.col(doc), variant_path(key), kind).alias(key)
        for key, kind in wanted.items()
    ]


def document_keys(documents: DataFrame, by: str, doc: str = "doc") -> DataFrame:
    """``by, key, type, n``: how many documents have the key, by the type of its value.

    Keys are counted in each task before anything is shuffled, so the listing of a
    store costs a pass over it and a shuffle of as many rows as there are keys.
    Documents that are no object have no keys.
    """
    members = documents.select(by, doc).lateralJoin(
        documents.sparkSession.tvf.variant_explode(F.col(doc).outer())
    )
    typed = members.where(F.col("key").isNotNull()).select(by, "key", F.schema_of_variant("value").alias("type"))
    return typed.groupBy(by, "key", "type").agg(F.count(F.lit(1)).alias("n"))


def document_schema(documents: DataFrame, by: str, doc: str = "doc") -> DataFrame:
    """``by, schema``: one type that takes the documents of each group."""
    return documents.groupBy(by).agg(F.schema_of_variant_agg(doc).alias("schema"))
