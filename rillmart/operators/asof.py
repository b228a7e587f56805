"""Joins to versions valid at a time: dimension rows and routing rules as they were when a record was made."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import col, micros

#: Length of the time slices that records and versions meet in.
WIDTH = timedelta(days=30)


def with_until(versions: DataFrame, keys: list[str], since: str = "since", until: str = "until") -> DataFrame:
    """Versions with the time the next one of their key begins, NULL for the last: for short tables, a key at a time."""
    w = Window.partitionBy(*keys).orderBy(since)
    return versions.withColumn(until, F.lead(since).over(w))


def as_of_join(df: DataFrame, versions: DataFrame, key: Column | str, time: Column | str, columns: dict[str, str], how: str = "inner",
               version_key: str = "id", since: str = "since", width: timedelta = WIDTH) -> DataFrame:
    """Add columns (``{output: version column}``) of the newest version with ``since`` at or before the record's time.

    Of versions of one key and time the greatest by their columns counts.  Records
    before the first version, or without key or time, are left out, or kept with
    ``how='left'``.  An output that already exists is replaced.

    Records and versions meet by key and time slice.  The version a slice begins with
    is found over one row per key and slice, so neither a key with very many records
    nor one with very many versions is a task of its own: only what lies in one slice
    of one key is compared.
    """
    step = micros(width)

    def slice_of(t: Column) -> Column:
        return F.floor(F.unix_micros(t) / step)

    record = F.struct(*[F.col(c) for c in df.columns])
    left = df.select(record.alias("r"), col(key).cast("string").alias("k"), col(time).alias("t"))
    left = left.withColumn("s", slice_of(F.col("t")))
    payload = F.struct(*[F.col(src).alias(f"c{i}") for i, src in enumerate(columns.values())])
    known = versions.select(F.col(version_key).cast("string").alias("k"), F.col(since).alias("since"), payload.alias("v")).filter(
        "k is not null and since is not null").withColumn("s", slice_of(F.col("since")))
    # One version per key and time.
    known = known.groupBy("k", "s", "since").agg(F.max("v").alias("v"))
    newest = known.groupBy("k", "s").agg(F.max(F.struct("since", "v")).alias("last"))
    asked = left.select("k", "s").filter("k is not null and s is not null").distinct()
    # Per key and slice the newest version of the slices before.
    steps = asked.select("k", "s", F.lit(None).cast(newest.schema["last"].dataType).alias("last"), F.lit(True).alias("asked")).unionByName(
        newest.select("k", "s", "last", F.lit(False).alias("asked")))
    before = Window.partitionBy("k").orderBy("s").rangeBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumn("last", F.last("last", True).over(before)).filter("asked and last is not null")
    met = carried.select("k", "s", "last.since", "last.v").unionByName(known.select("k", "s", "since", "v"))
    met = met.withColumn("until", F.lead("since").over(Window.partitionBy("k", "s").orderBy("since")))
    met = met.select(F.col("k").alias("vk"), F.col("s").alias("vs"), "since", "until", "v")
    found = left.join(met, (F.col("k") == F.col("vk")) & (F.col("s") == F.col("vs")) & (F.col("t") >= F.col("since"))
                      & (F.col("until").isNull() | (F.col("t") < F.col("until"))), how)
    keep = [c for c in df.columns if c not in columns]
    return found.select(*[F.col(f"r.`{c}`") for c in keep], *[F.col(f"v.c{i}").alias(out) for i, out in enumerate(columns)])
