"""Stats table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .topics import start


def with_dt(stats: DataFrame) -> DataFrame:
    """Add the day of the window start as ``dt`` (int), by which the table is partitioned."""
    return stats.withColumn("dt", F.replace(F.substring("stt", 1, 10), F.lit("-"), F.lit("")).cast("int"))


def save_stats(stats: DataFrame, path: str, columns: list[str], mode: str = "append", **options: str) -> None:
    """Batch write of the listed columns, partitioned by day; a day is written by as many tasks as its size asks for."""
    with_dt(stats.select(*columns)).hint("rebalance", "dt").write.mode(mode).options(**options).partitionBy("dt").parquet(path)


def stream_stats(stats: DataFrame, path: str, columns: list[str], checkpoint: str, **run) -> StreamingQuery:
    """Exactly-once append of closed windows, partitioned by day."""
    writer = with_dt(stats.select(*columns)).writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer.partitionBy("dt"), checkpoint, **run)


def stream_stats_jdbc(stats: DataFrame, url: str, table: str, columns: list[str], checkpoint: str,
                      batch_rows: int = 1000, every: str = "1 second", **options: str) -> StreamingQuery:
    """Append to a JDBC table, columns by position; a batch that is run again is written again."""
    def write(batch: DataFrame, _: int) -> None:
        batch.select(*columns).write.format("jdbc").mode("append").option("url", url).option(
            "dbtable", table).option("batchsize", batch_rows).options(**options).save()

    return start(stats.writeStream.outputMode("append").foreachBatch(write), checkpoint, every=every)
