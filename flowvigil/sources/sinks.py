"""Where rows, documents and messages go."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DESTINATION = ("es_index", "es_type")
#: Where Spark tells the id of the stream that a batch belongs to.
STREAM_ID = "sql.streaming.queryId"


def _exists(spark: SparkSession, folder: str) -> bool:
    try:
        spark.read.schema("id bigint").parquet(folder)
    except AnalysisException:
        return False
    return True


@dataclass(frozen=True)
class Target:
    """A table to write: a format, its options, and a location unless options name it.

    ``ledger`` is a shared folder of marks for targets that can only append.
    """

    format: str = "parquet"
    location: str | None = None
    mode: str = "append"
    options: Mapping[str, Any] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    ledger: str | None = None

    def write(self, df: DataFrame) -> None:
        writer = df.write.format(self.format).mode(self.mode).options(**self.options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.save(self.location)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write one micro-batch so that a retry replaces what it wrote before.

        File targets get a folder per stream and batch; a stream with a new
        checkpoint, or another stream, is another folder. Any other format is
        appended to, with the stream and the batch as columns (a Kafka topic has
        no columns to spare). With a ``ledger`` a batch leaves a mark there once
        it is written, and one that has a mark is not written again: what a retry
        can still repeat is a batch that was lost between its rows and its mark.
        """
        spark = df.sparkSession
        stream = spark.sparkContext.getLocalProperty(STREAM_ID) or "batch"
        part = f"stream_id={stream}/batch_id={batch_id}"
        if self.location is not None:
            folder = f"{self.location.rstrip('/')}/{part}"
            Target(self.format, folder, "overwrite", self.options, self.partition_by).write(df)
            return
        mark = None if self.ledger is None else f"{self.ledger.rstrip('/')}/{part}"
        if mark is not None and _exists(spark, mark):
            return
        if self.format == "kafka":
            self.write(df)
        else:
            self.write(df.withColumns({"stream_id": F.lit(stream), "batch_id": F.lit(batch_id)}))
        if mark is not None:
            spark.range(1).write.mode("overwrite").parquet(mark)


def jdbc_target(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    connections: int = 16,
) -> Target:
    """Append to a database table, with a bound on concurrent connections."""
    options = {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "batchsize": batch_size,
        "numPartitions": connections,
    }
    return Target("jdbc", None, "append", options)


def kafka_target(servers: str, topic: str) -> Target:
    return Target("kafka", None, "append", {"kafka.bootstrap.servers": servers, "topic": topic})


def documents(rows: DataFrame, key: str) -> DataFrame:
    """Rows of any layout as (es_index, es_type, id, document).

    Keys of the map ``extra`` stand beside the columns in the document.
    """
    known = [name for name in rows.columns if name != "extra"]
    document = F.to_json(F.struct(*[F.col(f"`{name}`") for name in known]))
    if "extra" in rows.columns:
        extra = F.coalesce(F.to_json("extra"), F.lit("{}"))
        both = F.concat(F.substring(document, F.lit(1), F.length(document) - 1), F.lit(","), F.substring(extra, 2, 1 << 30))
        document = F.when(extra == "{}", document).when(document == "{}", extra).otherwise(both)
    return rows.select(*DESTINATION, F.col(key).alias("id"), document.alias("document"))


def document_target(location: str, fmt: str = "parquet") -> Target:
    """Each row goes to the destination that its own tags name."""
    return Target(fmt, location, "append", {}, DESTINATION)


def rule_hits(hits: DataFrame) -> DataFrame:
    """(ruleid, rule_time, match_time) with epoch seconds as timestamps."""
    return hits.select(
        "ruleid",
        F.timestamp_seconds("rule_time").alias("rule_time"),
        F.timestamp_seconds("match_time").alias("match_time"),
    )
