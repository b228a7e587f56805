"""Sinks that write each batch of a stream once, with a ledger of what they wrote.

A batch of a sink is a folder ``<root>/<sink>/batch=<n>`` that appears whole: it is written under a hidden name and then renamed.
A batch that is there is never written again, so when a job dies between two sinks, or between its
sinks and its checkpoint, the batch that is run again fills in only what is missing, and a stream that reads a sink
meets no file twice.  Renaming a folder is one step on HDFS-like file systems, not on bare object stores.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .dims import complete
from .topics import start

ENTRY = "records bigint, sink string, batch bigint"


def _publish(spark: SparkSession, hidden: str, path: str) -> None:
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(hidden), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{hidden} could not be renamed to {path}")


def write_once(rows: DataFrame, path: str, batch_id: int, *partitions: str) -> bool:
    """Write one batch of a sink unless it is there; says whether it was written."""
    spark = rows.sparkSession
    if batch_id in complete(spark, path, "batch"):
        return False
    hidden = f"{path}/_attempts/{batch_id}-{uuid.uuid4().hex}"
    rows.write.partitionBy(*partitions).parquet(hidden)
    _publish(spark, hidden, f"{path}/batch={batch_id}")
    return True


def write_sinks(batch: DataFrame, batch_id: int, sinks: dict[str, Callable[[DataFrame], DataFrame]], root: str) -> None:
    """Write one batch to all sinks, and after each its entry in the ledger."""
    spark = batch.sparkSession
    for name, rows in sinks.items():
        write_once(rows(batch), f"{root}/{name}", batch_id)
        if batch_id not in complete(spark, f"{root}/ledger/{name}", "batch"):
            written = spark.read.parquet(f"{root}/{name}/batch={batch_id}")
            entry = written.agg(F.count(F.lit(1)).alias("records")).select("records", F.lit(name).alias("sink"), F.lit(batch_id).cast("bigint").alias("batch"))
            write_once(entry.coalesce(1), f"{root}/ledger/{name}", batch_id)


def to_sinks(stream: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], root: str, checkpoint: str, **run) -> StreamingQuery:
    """A stream into several sinks, ``{name: rows of a batch}``, each batch once in each."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_sinks(batch, batch_id, sinks, root)
        finally:
            batch.unpersist()

    return start(stream.writeStream.foreachBatch(write), checkpoint, **run)


def stream_sink(spark: SparkSession, root: str, name: str, schema: T.StructType | str) -> DataFrame:
    """What a sink has written, as the input of the next job."""
    return spark.readStream.schema(schema).parquet(f"{root}/{name}/batch=*").drop("batch")


def read_sink(spark: SparkSession, root: str, name: str, schema: T.StructType | str) -> DataFrame:
    folders = [f"{root}/{name}/batch={n}" for n in complete(spark, f"{root}/{name}", "batch")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, root: str, sinks: list[str]) -> DataFrame:
    """(sink, batch, records) of the finished batches."""
    folders = [f"{root}/ledger/{s}/batch={n}" for s in sinks for n in complete(spark, f"{root}/ledger/{s}", "batch")]
    rows = spark.read.schema(ENTRY).parquet(*folders) if folders else spark.createDataFrame([], ENTRY)
    return rows.select("sink", "batch", "records")
