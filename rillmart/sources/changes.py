"""Change-record sources: a snapshot first and then the log, or the log only."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .topics import file_topic


def row_map(df: DataFrame) -> F.Column:
    """All columns of a row as ``map<string,string>``, NULL values left out."""
    pairs = [part for c in df.columns for part in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def snapshot_records(table: DataFrame, database: str, name: str) -> DataFrame:
    """A table's present rows as change records with op ``READ``, the way an initial load emits them."""
    return table.select(
        F.lit(f"binlog.{database}.{name}").alias("topic"),
        F.lit("READ").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        row_map(table).alias("after"),
    )


def started_at(spark: SparkSession, checkpoint: str) -> str:
    """When a job with this checkpoint was first started, as text; the first call notes it beside the checkpoint.

    A restart finds the note and goes on from the same moment, so files that came
    while the job was down count as new.
    """
    note = f"{checkpoint.rstrip('/')}-started"
    try:
        return spark.read.parquet(note).first()["moment"]
    except AnalysisException:
        spark.sql("select date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSXXX\") as moment").coalesce(1).write.mode("overwrite").parquet(note)
        return spark.read.parquet(note).first()["moment"]


def change_lines(spark: SparkSession, path: str, startup: str = "initial", since: str | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """Stream of change lines from a folder.

    ``initial`` reads every file, the snapshot files included; ``latest`` only
    files written after ``since``, or after the first start of the job whose
    ``checkpoint`` is named, whichever is given.
    """
    if startup not in ("initial", "latest"):
        raise ValueError(f"startup must be initial or latest, not {startup!r}")
    lines = file_topic(spark, path)
    if startup == "initial":
        return lines
    if not (since or checkpoint):
        raise ValueError("latest needs the job's checkpoint, or the moment to start from")
    written = F.col("_metadata.file_modification_time")
    return lines.filter(written > F.lit(since or started_at(spark, checkpoint)).cast("timestamp")).select("value")
