"""Time-bounded joins and dimension joins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import col, interval, micros


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str,
                  right_time: str, lower: timedelta, upper: timedelta, span: int = 4) -> DataFrame:
    """Pairs of equal key whose right time lies in ``[left + lower, left + upper]``, ends included.

    Both sides are cut into time slices of ``span`` times the interval; a left
    row takes part in the one or two slices its interval meets, a right row in
    its own.  The slice is part of the join key, so a key with very many rows
    spreads over slices and only rows near in time are ever compared.

    Both sides are facts that grow without bound, so neither is ever broadcast:
    the join sorts and merges, and spills where memory ends.

    On streams the caller sets the watermarks; the bounds on the two times let
    Spark drop join state.
    """
    width = max(micros(upper) - micros(lower), 1) * span
    from_us = F.unix_micros(left_time) + micros(lower)
    to_us = F.unix_micros(left_time) + micros(upper)
    slices = F.sequence(F.floor(from_us / width), F.floor(to_us / width))
    l = left.withColumn("_ls", F.explode(slices))
    r = right.withColumn("_rs", F.floor(F.unix_micros(right_time) / width))
    return l.join(
        r.hint("merge"),
        (F.col(left_key) == F.col(right_key)) & (F.col("_ls") == F.col("_rs"))
        & (F.col(right_time) >= F.col(left_time) + interval(lower))
        & (F.col(right_time) <= F.col(left_time) + interval(upper)),
    ).drop("_ls", "_rs")


def dim_join(df: DataFrame, dim: DataFrame, key: Column | str, columns: dict[str, str],
             how: str = "inner", dim_key: str = "id") -> DataFrame:
    """Add dimension columns (``{output: dimension column}``) by key.

    Rows whose key is unknown are left out, or kept with ``how='left'``.  An
    output that already exists is replaced.  No hint is given: Spark broadcasts
    the dimension when its size allows and otherwise shuffles both sides, where
    adaptive execution splits skewed keys.
    """
    side = dim.select(F.col(dim_key).alias("_k"), *[F.col(src).alias(f"_d_{out}") for out, src in columns.items()])
    joined = df.join(side, col(key).cast("string") == F.col("_k"), how).drop("_k")
    keep = [c for c in df.columns if c not in columns]
    return joined.select(*keep, *[F.col(f"_d_{out}").alias(out) for out in columns])


def flat_sku(sku: DataFrame, spu: DataFrame, brand: DataFrame, category3: DataFrame, how: str = "inner") -> DataFrame:
    """The product dimensions as one table by SKU.

    Joining the small tables with each other first leaves a single join for the
    large fact side.
    """
    flat = dim_join(sku, spu, "spu_id", {"spu_name": "spu_name"}, how)
    flat = dim_join(flat, brand, "tm_id", {"tm_name": "tm_name"}, how)
    return dim_join(flat, category3, "category3_id", {"category3_name": "name"}, how)
