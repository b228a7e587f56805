"""Text topics and JSON topic tables.

A topic is a folder of text files, or a Kafka topic where the connector jar is
on the cluster's class path.  Both give a column ``value`` holding one record
per row, so everything downstream is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_topic(spark: SparkSession, path: str, stream: bool = True, files_per_batch: int | None = None) -> DataFrame:
    """Lines of a folder as rows ``value``; whole lines, whatever their length.

    Limit the files per batch only where they arrive in time order.
    """
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def kafka_topic(spark: SparkSession, servers: str, topics: str, starting: str = "latest",
                stream: bool = True, **options: str) -> DataFrame:
    """Kafka records as rows ``topic, partition, offset, timestamp, value``."""
    reader = spark.readStream if stream else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting if stream else "earliest")
        .options(**options)
        .load()
        .select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    )


def topic_table(lines: DataFrame, schema: T.StructType | str, event_time: Column,
                watermark: str = "2 seconds", view: str | None = None) -> DataFrame:
    """A topic declared as a table: columns of ``schema`` plus the event time ``rt``.

    With ``view`` the table is also registered for ``spark.sql``.
    """
    table = (
        lines.select(F.from_json("value", schema).alias("r"))
        .select("r.*")
        .withColumn("rt", event_time)
    )
    if table.isStreaming:
        table = table.withWatermark("rt", watermark)
    if view:
        table.createOrReplaceTempView(view)
    return table
