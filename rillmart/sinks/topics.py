"""Topic sinks.  Every query has a checkpoint; file sinks are exactly-once across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.parsing import to_json_lines


def start(writer: DataStreamWriter, checkpoint: str, once: bool = False, every: str | None = None) -> StreamingQuery:
    """Start a query.  ``once`` takes what is there in bounded batches and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def to_topic(df: DataFrame, path: str, checkpoint: str, form: str = "parquet", **run) -> StreamingQuery:
    """Append a stream to a folder topic as ``parquet``, ``json`` or ``text`` (one column ``value``)."""
    return start(df.writeStream.outputMode("append").format(form).option("path", path), checkpoint, **run)


def to_routed_topics(df: DataFrame, path: str, checkpoint: str, topic: str = "sink_table", **run) -> StreamingQuery:
    """Append rows (topic, value) to one text folder per topic, ``<path>/<topic>=<name>``."""
    writer = df.select(topic, "value").writeStream.outputMode("append").format("text").option("path", path)
    return start(writer.partitionBy(topic), checkpoint, **run)


def to_kafka(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None, **run) -> StreamingQuery:
    """Write ``value`` to one Kafka topic, or per row to the topic named in column ``topic``."""
    cols = ["value"] if topic else ["topic", "value"]
    writer = df.select(*cols).writeStream.outputMode("append").format("kafka").option(
        "kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return start(writer, checkpoint, **run)


def tee(lines: DataFrame, topic_path: str, daily_path: str, checkpoint: str, **run) -> StreamingQuery:
    """Write raw lines twice: to the ODS topic and to a copy by day of arrival.

    Both folders are written per batch under the batch's own name, so a batch
    that is run again replaces what it wrote.
    """
    def both(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.select("value").write.mode("overwrite").text(f"{topic_path}/batch={batch_id}")
            batch.select("value", F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("day")).write.mode(
                "overwrite").partitionBy("day").text(f"{daily_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return start(lines.writeStream.foreachBatch(both), checkpoint, **run)


def to_console(df: DataFrame, checkpoint: str, rows: int = 20, **run) -> StreamingQuery:
    """Debug print of each batch."""
    writer = df.writeStream.outputMode("append").format("console").option("numRows", rows).option("truncate", "false")
    return start(writer, checkpoint, **run)


def json_topic(df: DataFrame, path: str, checkpoint: str, **run) -> StreamingQuery:
    """Records as JSON lines, NULL fields left out."""
    return to_topic(to_json_lines(df), path, checkpoint, "text", **run)
