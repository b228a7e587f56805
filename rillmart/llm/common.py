"""Helpers the operators share: written tables, words, row keys."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder

#: Characters between words; a word is a run of anything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{new_folder(spark, label)}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array, in JVM code; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def buckets_for(spark: SparkSession, factor: int = 1) -> int:
    """How many hash buckets to deal work into: follows the session's shuffle partitions."""
    return factor * int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``; a plain reference inside a lambda would be worked out per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def apart(*read_here: str) -> Callable:
    """For an operator that hands on its caller's columns and reads those named: the others go under numbers, so that
    none is taken for a column of the operator's own."""
    def around(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            inner = {c: f"carried_{i}_" for i, c in enumerate(docs.columns) if c not in read_here}
            out = operator(docs.select(*[F.col(f"`{c}`").alias(inner.get(c, c)) for c in docs.columns]), *args, **kwargs)
            names = {i: c for c, i in inner.items()}
            return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns])

        return run

    return around
