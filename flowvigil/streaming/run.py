"""How a stream is triggered, and how a micro-batch is written."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from flowvigil.sources.sinks import Target


_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Streams started within keep their state in so many partitions, a setting that a
    checkpoint fixes at its first start. Each partition writes files at each batch,
    however little state it holds."""
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, number)
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


@dataclass(frozen=True)
class StreamOptions:
    """``checkpoint`` keeps the offsets on a shared file system: a batch that
    fails is run again. ``interval`` None takes what there is and stops.
    ``partitions`` deals each batch to so many tasks, for input in fewer pieces
    than there are cores; None leaves a batch as it comes. ``state`` is the number
    of partitions of the state (:func:`state_partitions`), and of a batch's other
    shuffles; None leaves it to the session."""

    checkpoint: str
    interval: str | None = "10 seconds"
    name: str | None = None
    partitions: int | None = None
    state: int | None = None

    def start(
        self, stream: DataFrame, each_batch: Callable[[DataFrame, int], None]
    ) -> StreamingQuery:
        writer = stream.writeStream.option("checkpointLocation", self.checkpoint)
        if self.name is not None:
            writer = writer.queryName(self.name)
        if self.interval is None:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.interval)
        # A stream takes the settings of its session when it starts.
        spark = stream.sparkSession
        with nullcontext() if self.state is None else state_partitions(spark, self.state):
            return writer.foreachBatch(self._dealt(each_batch)).start()

    def _dealt(
        self, each_batch: Callable[[DataFrame, int], None]
    ) -> Callable[[DataFrame, int], None]:
        if self.partitions is None:
            return each_batch
        return lambda batch, batch_id: each_batch(batch.repartition(self.partitions), batch_id)


class stored:  # noqa: N801
    """Keep tables of a micro-batch while several outputs are written from them."""

    def __init__(self, *tables: DataFrame):
        self._tables = tables

    def __enter__(self) -> tuple[DataFrame, ...]:
        return tuple(t.persist(StorageLevel.MEMORY_AND_DISK) for t in self._tables)

    def __exit__(self, *_: object) -> None:
        for table in self._tables:
            table.unpersist()


def write_outputs(
    outputs: Mapping[str, DataFrame], targets: Mapping[str, Target], batch_id: int
) -> None:
    """Write the outputs a target is named for; the others are never computed."""
    for name, target in targets.items():
        target.write_batch(outputs[name], batch_id)
