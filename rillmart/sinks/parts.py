"""Tables made of parts, of which a batch replaces only those it touches.

A part is a hash bucket of a dimension table (``buckets``) or a day of a stats
table (``days``).  A table is a folder with

* ``data/batch=<n>/part=<p>``: the rows of part ``p`` as batch ``n`` wrote them,
* ``state/batch=<n>``: a row per part with the batch that holds it, and the
  columns of the table.

The state is written last and counts once its ``_SUCCESS`` mark is there, so
readers see all parts of a batch or none, a batch cut short leaves nothing
behind that is read, and one that is run again starts from the state before it.
What the driver holds is one number per part.  One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dims import _remove, complete

PART = "part"
STATE = T.StructType([T.StructField("part", T.LongType()), T.StructField("batch", T.LongType()),
                      T.StructField("columns", T.StringType()), T.StructField("note", T.StringType())])


@dataclass(frozen=True)
class State:
    """Which batch holds each part, and the columns (without ``part``) of the table."""

    number: int
    parts: dict[int, int]
    columns: T.StructType
    note: str = ""

    def folders(self, path: str, parts: Iterable[int] | None = None) -> list[str]:
        wanted = self.parts if parts is None else set(parts) & self.parts.keys()
        return [f"{path}/data/batch={self.parts[p]}/{PART}={p}" for p in sorted(wanted)]


def states(spark: SparkSession, path: str) -> list[int]:
    return complete(spark, f"{path}/state", "batch")


def load_state(spark: SparkSession, path: str, number: int) -> State:
    rows = spark.read.schema(STATE).parquet(f"{path}/state/batch={number}").collect()
    head = next(r for r in rows if r.part is None)
    return State(number, {r.part: r.batch for r in rows if r.part is not None}, T.StructType.fromJson(json.loads(head.columns)), head.note)


def newest_state(spark: SparkSession, path: str, before: int | None = None) -> State | None:
    """The last finished state, or the last one before a batch."""
    numbers = [n for n in states(spark, path) if before is None or n < before]
    return load_state(spark, path, numbers[-1]) if numbers else None


def read_parts(spark: SparkSession, path: str, state: State, parts: Iterable[int] | None = None) -> DataFrame:
    """The rows of some parts, or of all, with their ``part``; only the folders of these parts are listed and read."""
    schema = T.StructType([*state.columns.fields, T.StructField(PART, T.LongType())])
    folders = state.folders(path, parts)
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema])


def write_parts(rows: DataFrame, path: str, number: int, replaced: Iterable[int], before: State | None, note: str = "") -> State:
    """Write ``rows`` (with their ``part``) as the present content of the ``replaced`` parts; the others stay where they are.

    A replaced part without rows is empty from now on.  ``rows`` should come with each part in few tasks.
    """
    spark = rows.sparkSession
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name != PART])
    folder = f"{path}/data/batch={number}"
    rows.write.mode("overwrite").partitionBy(PART).parquet(folder)
    filled = set(_parts_in(spark, folder))
    parts = {p: b for p, b in (before.parts if before else {}).items() if p not in set(replaced)}
    state = State(number, parts | {p: number for p in filled}, columns, note)
    table = [(None, None, columns.json(), note), *[(p, b, None, None) for p, b in sorted(state.parts.items())]]
    spark.createDataFrame(table, STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/state/batch={number}")
    return state


def _parts_in(spark: SparkSession, folder: str) -> list[int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{PART}=*")
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path) or []
    return [int(s.getPath().getName().split("=", 1)[1]) for s in found]


def tidy(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove part folders that none of the last ``keep`` states names, and older states; readers of those go on."""
    numbers = states(spark, path)
    old, kept = [load_state(spark, path, n) for n in numbers[:-keep]], [load_state(spark, path, n) for n in numbers[-keep:]]
    used = {f for s in kept for f in s.folders(path)}
    _remove(spark, sorted({f for s in old for f in s.folders(path)} - used) + [f"{path}/state/batch={s.number}" for s in old])


def replace_parts(spark: SparkSession, path: str, number: int, touched: Iterable[int],
                  build: Callable[[State | None], DataFrame], note: str = "", keep: int = 2) -> State:
    """One batch: ``build`` makes the touched parts from the state before it.  A batch that is finished already is left as it is."""
    done = states(spark, path)
    if number in done:
        return load_state(spark, path, number)
    if done and number < done[-1]:
        raise ValueError(f"batch {number} comes after batch {done[-1]} of {path}")
    before = newest_state(spark, path)
    state = write_parts(build(before), path, number, list(touched), before, note)
    tidy(spark, path, keep)
    return state
