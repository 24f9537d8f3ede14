"""Batch tables: any Spark format, CSV captures, JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.functions import once
from flowvigil.operators.http import FLOW_COLUMNS, TAG_COLUMNS
from flowvigil.operators.netflow import typed_records
from flowvigil.operators.sampling import take_rows


@dataclass(frozen=True)
class Source:
    """A table to read: a format, its options, and a location unless options name it."""

    format: str = "parquet"
    location: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.options).load(self.location)


def bounded(df: DataFrame, max_input_rows: int | None, keys: Sequence[str]) -> DataFrame:
    """The whole table, or ``max_input_rows`` of it where a bound is asked for."""
    return df if max_input_rows is None else take_rows(df, max_input_rows, keys)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal a table to so many partitions where the caller knows that it has too
    few, such as a single small file; None leaves it as it is."""
    return df if partitions is None else df.repartition(partitions)


def read_attack_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Attack captures with a header. Without a schema the types are inferred,
    which reads the files twice."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def jdbc_source(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> Source:
    """A database table. Large ones need the partition column and its bounds,
    or a single task reads them."""
    options: dict[str, Any] = {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "fetchsize": fetch_size,
    }
    if partition_column is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": lower_bound,
            "upperBound": upper_bound,
            "numPartitions": partitions,
        }
    return Source("jdbc", None, options)


def records_of(table: DataFrame) -> DataFrame:
    """Typed netflow records: of documents that the ETL stored, or the table itself.

    Only the destination ``netflow`` is read, which is a partition of the store.
    """
    if "document" not in table.columns:
        return table
    rows = table.where(F.col("es_index") == "netflow")
    parsed = once(rows, "record", F.from_json("document", "map<string,string>"))
    packets = F.col("record")["packernum"].try_cast("bigint")
    return typed_records(parsed.withColumn("recordid", F.col("id")).withColumn("packernum", packets))


def flows_of(table: DataFrame) -> DataFrame:
    """Flow rows: of documents that the ETL stored, or the table itself."""
    if "document" not in table.columns:
        return table
    rows = table.where(F.col("es_index") == "flow")
    parsed = once(rows, "_flow", F.from_json("document", "map<string,string>"))
    flow = F.col("_flow")
    given = [name for name in FLOW_COLUMNS if name != "date"]
    known = (*FLOW_COLUMNS, *TAG_COLUMNS, "flowcontent")
    return parsed.select(
        *TAG_COLUMNS,
        *[flow[name].alias(name) for name in given],
        flow["date"].try_cast("bigint").alias("date"),
        F.map_filter(flow, lambda key, _: ~key.isin(*known)).alias("extra"),
    )


def rules_table(rules: DataFrame, order: str | None = None) -> DataFrame:
    """The rule columns with ``rule_pos``: by a column, or, for a single file that
    one task reads, in reading order."""
    position = F.monotonically_increasing_id() if order is None else F.col(order)
    return rules.select(
        position.alias("rule_pos"), "ruleid", "sourceip", "destip", "rule_regular_expression"
    )


def rows(spark: SparkSession, values: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from values in hand, with an explicit schema."""
    return spark.createDataFrame(list(values), schema)
