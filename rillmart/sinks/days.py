"""Stats tables kept by day that follow their input files.

A table knows, in a ledger, which days the records of each input file belong to.  A refresh lists the
inputs, reads the files it has not seen, and rebuilds the days that these, or files
that are gone or were replaced, hold records of; all other days stay the files they are.  Another
``version``, a text that names the code and the bounds a table is built with, rebuilds all days.

For statistics whose day depends on records of a bounded span only: ``Input.days`` names every day a
record can change, for instance two days where a window or a join reaches over midnight.

Days are parts (``parts``): a refresh shows at once or not at all.  The ledger is a table beside them; the driver holds the days and the
paths of the files that arrived.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefns import yyyymmdd
from .parts import PART, State, newest_state, read_parts, replace_parts, states
from .stats import with_dt

LEDGER = "input string, file string, length bigint, modified timestamp, day bigint"
FILE = ["input", "file", "length", "modified"]


@dataclass(frozen=True)
class Input:
    """Parquet files below a folder, and the days (``yyyyMMdd``, an array) whose statistics a record of them can change."""

    name: str
    folder: str
    days: Callable[[DataFrame], Column]


def in_days(time: str, days: list[int]) -> Column:
    """Whether a time is of one of the days, with bounds that reach the scan."""
    if not days:
        return F.lit(False)
    low, high = (F.to_timestamp(F.lit(str(d)), "yyyyMMdd") for d in (min(days), max(days)))
    return (F.col(time) >= low) & (F.col(time) < high + F.expr("interval 1 day")) & yyyymmdd(time).isin(days)


def _of_file(name: str) -> list[Column]:
    m = F.col("_metadata")
    return [F.lit(name).alias("input"), m["file_path"].alias("file"), m["file_size"].alias("length"), m["file_modification_time"].alias("modified")]


def _listed(spark: SparkSession, source: Input) -> DataFrame:
    """A row per file there is, without reading it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(source.folder)
    return files.select(*_of_file(source.name))


def _seen(spark: SparkSession, path: str, state: State | None) -> DataFrame:
    if state is None:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/batch={state.number}")


def _days_of(spark: SparkSession, source: Input, files: list[str]) -> DataFrame:
    """The days of each file; a file without records has one row without a day, so that it counts as seen."""
    rows = spark.read.parquet(*files)
    held = rows.select(*_of_file(source.name), F.explode_outer(source.days(rows).cast("array<bigint>")).alias("day")).distinct()
    listed = spark.read.format("binaryFile").load(files).select(*_of_file(source.name))
    return held.unionByName(listed.select(*FILE, F.lit(None).cast("bigint").alias("day")))


def refresh(spark: SparkSession, path: str, inputs: list[Input], build: Callable[[list[int]], DataFrame], version: str) -> list[int]:
    """Bring the table up to date and say which days were rebuilt, in order.

    ``build`` makes the rows, with ``stt``, of the days it is given, from all input files; other days' rows are left out of what it returns.
    """
    state = newest_state(spark, path)
    seen = _seen(spark, path, state)
    listed = reduce(DataFrame.unionByName, [_listed(spark, s) for s in inputs])
    came = [(r.input, r.file) for r in listed.join(seen.select(*FILE), FILE, "left_anti").toLocalIterator()]
    gone = seen.join(listed, FILE, "left_anti")
    parts = [_days_of(spark, s, files) for s in inputs if (files := sorted(f for name, f in came if name == s.name))]
    fresh = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], LEDGER)
    number = (states(spark, path) or [-1])[-1] + 1
    ledger = f"{path}/ledger/batch={number}"
    seen.join(listed, FILE, "left_semi").unionByName(fresh).write.mode("overwrite").parquet(ledger)
    if state is not None and state.note == version:
        changed = spark.read.schema(LEDGER).parquet(ledger).join(seen.select(*FILE), FILE, "left_anti").unionByName(gone)
    else:
        changed = spark.read.schema(LEDGER).parquet(ledger)
    days = sorted(r.day for r in changed.filter("day is not null").select("day").distinct().toLocalIterator())
    replaced = set(days) if state is not None and state.note == version else set(days) | set(state.parts if state else ())

    def rows(_: State | None) -> DataFrame:
        made = with_dt(build(days)).filter(F.col("dt").isin(days) if days else F.lit(False))
        return made.withColumnRenamed("dt", PART).repartition(max(len(days), 1), PART)

    if replaced or state is None:
        replace_parts(spark, path, number, replaced, rows, version)
    return days


def read_days(spark: SparkSession, path: str, days: list[int] | None = None) -> DataFrame:
    """The table with its day as ``dt``; with ``days`` the folders of these days only."""
    state = newest_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table by day at {path}")
    return read_parts(spark, path, state, days).withColumn("dt", F.col(PART).cast("int")).drop(PART)
