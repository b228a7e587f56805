"""Results kept as tables in shared storage, under a name that holds the state of their inputs, of the code and of its bounds.

Each builder writes a folder of its own below that name and readers take the first finished one, so sessions that build
the same table at once do not meet.  Tables whose inputs grow by files are better kept by day (``days``).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder
from .stats import save_stats


def file_system(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _input_files(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of the tables' files."""
    seen = []
    for table in tables:
        path, fs = file_system(spark, f"{sf_dir}/{table}.parquet")
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return seen


def input_state(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    """A digest of the names, sizes and times of the tables' files: another one as soon as a file changes."""
    seen = [sf_dir, *[f"{path} {size} {time}" for path, size, time in _input_files(spark, sf_dir, tables)]]
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:20]


#: Bytes of input files for each partition of a shuffle while a table is built.
PARTITION_BYTES = 8 << 20


@contextmanager
def _enough_partitions(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]):
    """As many shuffle partitions as the input asks for, so that what one task sorts does not grow with it; adaptive plans put small ones together."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = -(-sum(size for _, size, _ in _input_files(spark, sf_dir, tables)) // PARTITION_BYTES)
    spark.conf.set(key, str(max(int(before), needed)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@cache
def code_state() -> str:
    """A digest of the sources that make tables: what older code has built is not served."""
    here = Path(__file__).resolve().parent.parent
    files = sorted(f for part in ("functions", "operators", "plans", "sources", "sinks") for f in (here / part).glob("*.py"))
    seen = hashlib.sha256()
    for f in [*files, here / "codes.py", here / "schemas.py"]:
        seen.update(f.relative_to(here).as_posix().encode() + b"\0" + f.read_bytes() + b"\0")
    return seen.hexdigest()[:12]


def _finished(spark: SparkSession, folder: str) -> list[str]:
    path, fs = file_system(spark, f"{folder}/built-*/_SUCCESS")
    return sorted(s.getPath().getParent().toString() for s in fs.globStatus(path) or [])


def kept_table(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...], build: Callable[[], DataFrame],
               by_day: bool = False, settings: tuple = ()) -> DataFrame:
    """The table ``name`` made by ``build`` from the input ``tables``; built when it is not there yet.

    ``settings`` are the bounds ``build`` goes by; other ones make another table.
    With ``by_day`` it is a stats table, partitioned by the day of its windows.
    """
    bounds = hashlib.sha256(repr(settings).encode()).hexdigest()[:8]
    folder = f"{shared_folder(spark)}/tables/{name}-{input_state(spark, sf_dir, tables)}-{code_state()}-{bounds}"
    if not (built := _finished(spark, folder)):
        own = f"{folder}/built-{uuid.uuid4().hex}"
        with _enough_partitions(spark, sf_dir, tables):
            rows = build()
            if by_day:
                save_stats(rows, own, rows.columns, "overwrite")
            else:
                rows.write.mode("overwrite").parquet(own)
        built = [own]
    return spark.read.parquet(built[0])
