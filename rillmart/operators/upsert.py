"""Upsert of keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .routing import newest

#: Names the columns a change sets; the others keep their value.
PRESENT = "_present"


def merge_changes(changes: DataFrame, key: str, order_by: str, present: str = PRESENT) -> DataFrame:
    """One row per key with the newest value of every column any of its changes sets, and the names of those columns.

    Each column is a maximum over (order, value), summed up on the map side.
    """
    columns = [c for c in changes.columns if c not in (key, order_by, present)]
    tops = changes.groupBy(key).agg(
        F.max(order_by).alias(order_by),
        *[F.max(F.when(F.array_contains(present, c), F.struct(order_by, F.col(c).alias("v")))).alias(c) for c in columns])
    names = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns], F.lit(None).cast("string")))
    return tops.select(key, *[F.col(c)["v"].alias(c) for c in columns], order_by, names.alias(present))


def upsert(base: DataFrame, changes: DataFrame, key: str, order_by: str, present: str | None = None) -> DataFrame:
    """``base`` with the newest change of each key put in place of its row, or added.

    With ``present``, the name of an array column, a change sets only the columns
    it names, and a column the base does not know yet is added to it.  The base is
    only filtered, never sorted; a small batch of changes is broadcast and leaves
    the base where it lies.
    """
    if present is None:
        fresh = newest(changes, key, order_by).select(*base.columns)
        return base.join(fresh.select(key), key, "left_anti").select(*base.columns).unionByName(fresh)
    fresh = merge_changes(changes, key, order_by, present)
    more = [c for c in fresh.columns if c not in (*base.columns, order_by, present)]
    wide = base.withColumns({c: F.lit(None).cast(fresh.schema[c].dataType) for c in more})
    rest = [c for c in wide.columns if c != key]
    touched = wide.join(fresh.select(key), key, "left_semi").select(F.col(key), *[F.col(c).alias(f"_was_{c}") for c in rest])

    def value(c: str) -> Column:
        was = F.col(f"_was_{c}")
        return F.when(F.array_contains(present, c), F.col(c)).otherwise(was) if c in fresh.columns else was

    merged = fresh.join(touched, key, "left").select(key, *[value(c).alias(c) for c in rest])
    return wide.join(fresh.select(key), key, "left_anti").select(key, *rest).unionByName(merged).select(*wide.columns)


def as_text(df: DataFrame) -> DataFrame:
    """Dimension tables hold text only."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
