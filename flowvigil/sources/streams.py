"""Streams of log lines and messages, as ``(key, value)`` strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from flowvigil.functions import ORIGIN

LINE_SCHEMA = "key string, value string"


def offsets_per_trigger(lines_per_second: int, partitions: int, seconds: int) -> int:
    """Intake of one trigger from a cap per partition and second."""
    return lines_per_second * partitions * seconds


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Lines of Kafka topics; the connector has to be on the class path.

    ``origin`` names the topic, partition and offset: ids made of it are unique.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().selectExpr(
        "cast(key as string) key",
        "cast(value as string) value",
        f"concat_ws('/', topic, partition, offset) as {ORIGIN}",
    )


def file_lines(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str = LINE_SCHEMA,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Lines of files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
