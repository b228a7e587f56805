"""Daily reports over the stats tables.

``date`` is a day as ``yyyyMMdd``.  With None a report covers every day of the
table, a column ``dt`` telling them apart and limits holding per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import codes
from ..functions.numbers import bounce_rate, pages_per_visit, seconds_per_visit
from ..functions.text import pad2
from ..functions.timefns import hour_of, parse_stamp, today_yyyymmdd, yyyymmdd
from ..sources.tables import for_day

KEYWORD_LIMIT = 20
TOP_LIMIT = 10
BRAND_ALL_LIMIT = 5


def today(spark) -> int:
    """The default day of a report."""
    return spark.range(1).select(today_yyyymmdd()).first()[0]


def _dated(stats: DataFrame, date: int | None) -> tuple[DataFrame, list[str]]:
    """Rows of the day, and the extra grouping column when all days are asked for."""
    rows = for_day(stats, date)
    if date is not None:
        return rows, []
    return rows.withColumn("dt", yyyymmdd(parse_stamp("stt"))), ["dt"]


def _top(df: DataFrame, per: list[str], order: list[Column], limit: int) -> DataFrame:
    if not per:
        return df.orderBy(*order).limit(limit)
    w = Window.partitionBy(*per).orderBy(*order)
    ranked = df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit)
    return ranked.orderBy(*per, "_n").drop("_n")


def gmv(stats: DataFrame, date: int | None = None) -> DataFrame:
    """Turnover of a day: one row, NULL when the day has none."""
    rows, per = _dated(stats, date)
    total = F.sum("order_amount").cast("double").alias("gmv")
    return rows.groupBy(*per).agg(total) if per else rows.agg(total)


def _top_amount(stats: DataFrame, keys: list[str], date: int | None, limit: int, positive: bool = True,
                extra: list[Column] | None = None) -> DataFrame:
    rows, per = _dated(stats, date)
    out = rows.groupBy(*per, *keys).agg(F.sum("order_amount").alias("order_amount"), *(extra or []))
    if positive:
        out = out.filter("order_amount > 0")
    ranked = _top(out, per, [F.col("order_amount").desc_nulls_last(), *[F.col(k).asc() for k in reversed(keys)]], limit)
    return ranked.withColumn("order_amount", F.col("order_amount").cast("double"))


def brand_gmv(stats: DataFrame, date: int | None = None, limit: int = TOP_LIMIT) -> DataFrame:
    return _top_amount(stats, ["tm_id", "tm_name"], date, limit)


def brand_gmv_all(stats: DataFrame, date: int | None = None, limit: int = BRAND_ALL_LIMIT) -> DataFrame:
    """Variant by brand name only, brands without turnover included."""
    return _top_amount(stats, ["tm_name"], date, limit, positive=False)


def category3_gmv(stats: DataFrame, date: int | None = None, limit: int = TOP_LIMIT) -> DataFrame:
    return _top_amount(stats, ["category3_id", "category3_name"], date, limit)


def spu_gmv(stats: DataFrame, date: int | None = None, limit: int = TOP_LIMIT) -> DataFrame:
    """Turnover and orders per SPU; orders are added up over windows."""
    return _top_amount(stats, ["spu_id", "spu_name"], date, limit,
                       extra=[F.sum("order_ct").alias("order_ct")])


def province_gmv(stats: DataFrame, date: int | None = None) -> DataFrame:
    rows, per = _dated(stats, date)
    return rows.groupBy(*per, "province_id", "province_name").agg(
        F.sum("order_amount").cast("double").alias("order_amount")).drop("province_id")


def visitors_by_new(stats: DataFrame, date: int | None = None) -> DataFrame:
    rows, per = _dated(stats, date)
    return rows.groupBy(*per, "is_new").agg(
        *[F.sum(m).alias(m) for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")])


def visitors_by_hour(stats: DataFrame, date: int | None = None) -> DataFrame:
    rows, per = _dated(stats, date)
    new_uv = F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)
    out = rows.groupBy(*per, hour_of(parse_stamp("stt")).alias("hr")).agg(
        F.sum(new_uv).alias("new_uv"), *[F.sum(m).alias(m) for m in ("uv_ct", "pv_ct", "uj_ct")])
    return out.orderBy(*per, "hr")


def keyword_scores(stats: DataFrame, date: int | None = None, limit: int = KEYWORD_LIMIT,
                   weights: dict[str, int] | None = None) -> DataFrame:
    """Weighted score per keyword, ranked by the unweighted count."""
    rows, per = _dated(stats, date)
    out = rows.groupBy(*per, "keyword").agg(
        F.sum(F.col("ct") * codes.keyword_weight("source", weights)).alias("score"), F.sum("ct").alias("_raw"))
    return _top(out, per, [F.col("_raw").desc(), F.col("keyword").asc()], limit).drop("_raw").withColumnRenamed(
        "score", "ct")


# --- shapes -----------------------------------------------------------------

def with_ratios(by_new: DataFrame) -> DataFrame:
    """Bounce rate, seconds per visit and pages per visit beside the sums."""
    return by_new.withColumns({
        "uj_rate": bounce_rate(), "dur_per_sv": seconds_per_visit(), "pv_per_sv": pages_per_visit()})


def full_day(by_hour: DataFrame) -> DataFrame:
    """All 24 hours of one day: hours without visits count 0, labelled ``00`` to ``23``."""
    hours = by_hour.sparkSession.range(24).select(F.col("id").cast("int").alias("hr"))
    measures = [c for c in by_hour.columns if c != "hr"]
    return hours.join(by_hour, "hr", "left").select(
        pad2("hr").alias("hr"), *[F.coalesce(m, F.lit(0)).alias(m) for m in measures]).orderBy("hr")


def new_against_old(by_new: DataFrame) -> DataFrame:
    """Five measures as rows (type, new, old); every flag but ``'1'`` is old.

    The two sides are summed before the ratios are taken; a side without
    visitors shows 0.
    """
    is_new = F.col("is_new").eqNullSafe("1")
    sides = by_new.groupBy(is_new.alias("fresh")).agg(
        *[F.sum(m).alias(m) for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")])
    rows = with_ratios(sides).select("fresh", F.expr(
        "stack(5, 'visitors', double(uv_ct), 'pages', double(pv_ct), 'bounce_rate', uj_rate, "
        "'seconds_per_visit', dur_per_sv, 'pages_per_visit', pv_per_sv) as (type, amount)"))
    side = lambda flag: F.coalesce(F.max(F.when(F.col("fresh") == flag, F.col("amount"))), F.lit(0.0))
    return rows.groupBy("type").agg(side(True).alias("new"), side(False).alias("old"))


def name_value(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.select(F.col(name).alias("name"), F.col(value).alias("value"))


def series(top: DataFrame, name: str, value: str) -> DataFrame:
    """A ranked report (at most its limit of rows) as one row of two lists in rank order."""
    pairs = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("o"), F.col(name).alias("n"),
                                                 F.col(value).alias("v"))))
    return top.agg(pairs.alias("p")).select(F.col("p.n").alias("categories"), F.col("p.v").alias("series"))
