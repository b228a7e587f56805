"""Amounts and ratios; decimals round half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timefns import col

MONEY = "decimal(16,2)"


def money(c: Column | str) -> Column:
    """Amounts are fixed-point before any sum, so sums do not depend on row order."""
    return col(c).cast(MONEY)


def loose_long(c: Column | str) -> Column:
    """Number in text, quoted or with decimals -> long without the decimals, NULL where it is none."""
    return col(c).try_cast("decimal(38,6)").try_cast("bigint")


def _quotient(top: Column, bottom: Column, scale: int) -> Column:
    return F.round(top.cast("decimal(20,0)") / bottom.cast("decimal(20,0)"), scale)


def _guarded(value: Column) -> Column:
    """Ratios are 0 without visitors and, to avoid dividing by zero, without visits."""
    live = (F.col("uv_ct") != 0) & (F.col("sv_ct") != 0)
    return F.when(live, value).otherwise(F.lit(0)).cast("double")


def bounce_rate() -> Column:
    """Percent of visits that bounced, two decimals."""
    return _guarded(_quotient(F.col("uj_ct") * 100, F.nullif(F.col("sv_ct"), F.lit(0)), 2))


def seconds_per_visit() -> Column:
    """Milliseconds per visit rounded to whole ones first, then to tenths of a second."""
    whole = _quotient(F.col("dur_sum"), F.nullif(F.col("sv_ct"), F.lit(0)), 0)
    return _guarded(F.round(whole / F.lit(1000), 1))


def pages_per_visit() -> Column:
    return _guarded(_quotient(F.col("pv_ct"), F.nullif(F.col("sv_ct"), F.lit(0)), 2))
