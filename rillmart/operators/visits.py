"""Daily unique visits and bounces (batch; the stream forms are in ``streaming``)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import day_of_millis
from .logs import ORDER

WITHIN = timedelta(seconds=10)


def entries(log: DataFrame) -> DataFrame:
    """Records that open a visit: no page came before."""
    return log.filter(F.col("page.last_page_id").isNull())


def unique_visit(log: DataFrame, order_by: tuple[str, ...] = ORDER) -> DataFrame:
    """The first entry of each visitor on each day, the whole record.

    Row numbers are limited to one on the map side before the shuffle, so
    neither a busy visitor nor a busy day gathers in one task.
    """
    w = Window.partitionBy("common.mid", "_day").orderBy(*order_by)
    days = entries(log).withColumn("_day", day_of_millis("ts"))
    return days.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_day")


def entry_fates(log: DataFrame, within: timedelta = WITHIN, order_by: tuple[str, ...] = ORDER,
                span: int = 30) -> DataFrame:
    """Every entry with its ``fate`` by the visitor's next record.

    ``timeout``: none follows within the time bound; ``matched``: an entry
    follows; ``killed``: a page of the same visit follows.

    A visitor's records are cut into time slices of ``span`` times the bound,
    and records less than one bound into a slice are also handed to the slice
    before, where they can only be looked at.  So the next record within the
    bound is always at hand, and a very busy visitor is many small groups
    instead of one, for about ``1/span`` more rows.
    """
    bound = within // timedelta(milliseconds=1)
    width = bound * span
    home = F.floor(F.col("ts") / width)
    early = F.pmod("ts", F.lit(width)) < bound
    # The visitor is a plain column: over a struct's field every window expression would plan an exchange of its own.
    sliced = log.withColumns({"_home": home, "_mid": F.col("common.mid")}).withColumn(
        "_slice", F.explode(F.when(early, F.array("_home", F.col("_home") - 1)).otherwise(F.array("_home"))))
    w = Window.partitionBy("_mid", "_slice").orderBy(*order_by)
    fate = (
        F.when(F.col("_next.ts").isNull() | (F.col("_next.ts") >= F.col("ts") + bound), "timeout")
        .when(F.col("_next.last").isNull(), "matched")
        .otherwise("killed")
    )
    walked = sliced.withColumn("_next", F.lead(F.struct("ts", F.col("page.last_page_id").alias("last"))).over(w))
    return (
        entries(walked).filter("_slice = _home")
        .withColumn("fate", fate)
        .select(*log.columns, "fate")
    )


def user_jump(log: DataFrame, within: timedelta = WITHIN, order_by: tuple[str, ...] = ORDER,
              fates: tuple[str, ...] = ("matched", "timeout")) -> DataFrame:
    """Bounces: entries followed by another entry or by nothing within the bound."""
    return entry_fates(log, within, order_by).filter(F.col("fate").isin(*fates)).drop("fate")
