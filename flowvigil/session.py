"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings worth having on any cluster that runs these jobs.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def builder(app_name: str) -> SparkSession.Builder:
    build = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        build = build.config(key, value)
    return build


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    context = spark.sparkContext
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder the session names.

    A session in local mode that names none gets a temporary folder. On a
    cluster a folder of one machine would be lost with it, so the setting is
    required there.
    """
    base = _configured_checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="flowvigil-")
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Bytes of a row group, which a task that writes holds in memory.
ROW_GROUP = 32 << 20


@contextmanager
def written(purpose: str, *tables: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Tables that several steps read, written to the shared folder until these are done.

    For tables that may outgrow the memory. A cache goes to disk in column batches of
    some megabytes, a hundred of which a task holds as it writes or reads them (Java's
    serialisation), beside what Spark accounts for; here a task holds a row group.
    """
    folders = []
    try:
        found = []
        for table in tables:
            folders.append(work_folder(table.sparkSession, purpose))
            table.write.option("parquet.block.size", ROW_GROUP).parquet(folders[-1])
            found.append(table.sparkSession.read.schema(table.schema).parquet(folders[-1]))
        yield tuple(found)
    finally:
        for folder, table in zip(folders, tables, strict=False):
            _delete(table.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df):
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    work_folder(df.sparkSession, "checkpoint")
    return df.checkpoint(eager=True)
