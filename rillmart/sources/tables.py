"""Table readers: Parquet, dimension and stats tables, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import camel_columns
from ..functions.timefns import day_bounds


def zoned(df: DataFrame) -> DataFrame:
    """Turn zone-less timestamps into TIMESTAMP, which watermarks and windows need."""
    return df.select(*[
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return zoned(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The same Parquet table as a stream of its files.

    By default all files present make one batch.  Limit the files per batch only
    where they lie in time order: a later batch behind the watermark is late data.
    """
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # As a glob the path may be a folder or a single file; a plain file is refused by the stream reader.
    return zoned(reader.parquet(f"{sf_dir}/{name}.parque[t]"))


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, camel: bool = False, **options: str) -> DataFrame:
    """Rows of a JDBC query, split over executors when partition options are given.

    ``camel`` renames snake-case columns to camel case.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if table_or_query.lstrip().lower().startswith("select"):
        table_or_query = f"({table_or_query}) q"
    rows = reader.option("dbtable", table_or_query).options(**options).load()
    return camel_columns(rows) if camel else rows


def lookup(dim: DataFrame, key: str, value: object) -> DataFrame:
    """One dimension row by key; the filter reaches the Parquet scan."""
    return dim.filter(F.col(key) == F.lit(str(value)))


def for_day(stats: DataFrame, date: int | None) -> DataFrame:
    """Stats rows whose window starts on a day (``yyyyMMdd``), all rows for None.

    A table partitioned by ``dt`` is pruned by partition; otherwise the text
    range on ``stt`` is pushed down to the file statistics.
    """
    if date is None:
        return stats
    if "dt" in stats.columns:
        return stats.filter(F.col("dt") == date)
    start, end = day_bounds(date)
    return stats.filter((F.col("stt") >= start) & (F.col("stt") < end))
