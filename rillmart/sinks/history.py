"""Versions of dimension and config rows, kept with the time each became valid.

A table is a folder with a subfolder per batch of changes; a batch that is run again
replaces its own.  Only finished batches are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .dims import complete
from .topics import start


def append_versions(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions known now; none where nothing has been written yet."""
    folders = [f"{path}/batch={b}" for b in complete(spark, path, "batch")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def stream_versions(changes: DataFrame, path: str, checkpoint: str, **run) -> StreamingQuery:
    """Append a stream of changes, each with its time, to their versions."""
    return start(changes.writeStream.foreachBatch(lambda batch, n: append_versions(batch, path, n)), checkpoint, **run)
