"""Config-driven routing of change records to fact topics and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import with_until

TO_DIM, TO_TOPIC = "hbase", "kafka"


def drop_deletes(changes: DataFrame) -> DataFrame:
    """All but deletes; a missing type passes."""
    return changes.filter(~F.col("type").eqNullSafe("delete"))


def newest(df: DataFrame, key: str | list[str], order_by: str | list[str]) -> DataFrame:
    """Newest row per key.  Spark keeps one row per key on the map side already."""
    keys = [key] if isinstance(key, str) else key
    order = [order_by] if isinstance(order_by, str) else order_by
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def current_routing(config_changes: DataFrame, order_by: str) -> DataFrame:
    """Newest routing row per (sourceTable, operateType) of a change log with a ``type`` column; deleted ones are gone."""
    latest = newest(config_changes, ["sourceTable", "operateType"], order_by)
    return drop_deletes(latest).drop("type", order_by)


def _route(changes: DataFrame, config: DataFrame, *more: Column, valid: Column | None = None) -> DataFrame:
    # Sent to every task: dealt out by table and operation, all changes of a large table would meet in one task.
    rules = F.broadcast(config.select(
        F.col("sourceTable").alias("_t"), F.col("operateType").alias("_o"),
        "sinkType", "sinkTable", "sinkPk", F.split("sinkColumns", ",").alias("_keep"), *more))
    same = (F.col("tableName") == F.col("_t")) & (F.col("type") == F.col("_o"))
    joined = drop_deletes(changes).join(rules, same if valid is None else same & valid)
    kept = F.map_filter("after", lambda k, _: F.array_contains(F.col("_keep"), k))
    return joined.withColumn("after", kept).drop("_t", "_o", "_keep", "_since", "_until")


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Join change envelopes with their routing and keep only the listed columns of ``after``.

    Records without routing are left out.  The config is a short table, a row per
    source table and operation, and is broadcast; the changes stay where they are.
    """
    return _route(changes, config)


def route_as_of(changes: DataFrame, versions: DataFrame, time: str) -> DataFrame:
    """Route each change by the config as it was at the change's ``time``.

    ``versions`` holds routing rows with the time each became valid, ``since``, and a
    ``change``, which is ``delete`` where a rule was taken away.  Of rows of one rule
    and time one that is no delete counts.  Changes before the first version, while
    a rule is gone, or without a time are left out.
    """
    keys = ["sourceTable", "operateType"]
    one = versions.withColumn("_gone", F.col("change").eqNullSafe("delete")).dropna(subset=[*keys, "since"])
    w = Window.partitionBy(*keys, "since").orderBy("_gone")
    valid = with_until(one.withColumn("_n", F.row_number().over(w)).filter("_n = 1"), keys).filter("not _gone")
    at = F.col(time)
    return _route(changes, valid, F.col("since").alias("_since"), F.col("until").alias("_until"),
                  valid=(at >= F.col("_since")) & (F.col("_until").isNull() | (at < F.col("_until"))))


def dim_changes(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sinkType") == TO_DIM)


def fact_changes(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sinkType") == TO_TOPIC)


def map_columns(routed: DataFrame, sink_table: str, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one sink table with its map spread into text columns."""
    return routed.filter(F.col("sinkTable") == sink_table).select(
        *[F.col("after")[c].alias(c) for c in columns], *keep)
