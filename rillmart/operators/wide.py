"""Order-wide and payment-wide records."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import MONEY
from ..functions.timefns import age_years, moment, stamp_date, stamp_hour, to_millis
from .asof import as_of_join
from .joins import dim_join, flat_sku, interval_join

ORDER_LOWER, ORDER_UPPER = timedelta(seconds=-5), timedelta(seconds=5)
PAY_LOWER, PAY_UPPER = timedelta(minutes=-15), timedelta(seconds=5)
IN_ORDER = "1 millisecond"  # watermark delay of inputs whose times only grow


@dataclass
class Dims:
    """Dimension tables; every column text, ``id`` unique."""

    user: DataFrame
    province: DataFrame
    sku: DataFrame
    spu: DataFrame
    brand: DataFrame
    category3: DataFrame

    def product(self, how: str = "inner") -> DataFrame:
        return flat_sku(self.sku, self.spu, self.brand, self.category3, how)


def order_times(orders: DataFrame) -> DataFrame:
    """Add create_date, create_hour and create_ts to orders."""
    return (
        orders.withColumn("create_date", stamp_date("create_time"))
        .withColumn("create_hour", stamp_hour("create_time"))
        .withColumn("create_ts", to_millis(moment(orders, "create_time")))
    )


def _timed(df: DataFrame, text: str, name: str, delay: str) -> DataFrame:
    out = df.withColumn(name, moment(df, text))
    return out.withWatermark(name, delay) if df.isStreaming else out


# The fields of the record, by where they come from.
ORDER_FIELDS = [
    "order_status", "create_time", "create_date", "create_hour", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "total_amount", "province_id", "user_id",
]
DETAIL_FIELDS = [
    "sku_id", "sku_name", "order_price", "sku_num", "split_activity_amount", "split_coupon_amount",
    "split_total_amount",
]


def join_order_detail(orders: DataFrame, details: DataFrame, lower: timedelta = ORDER_LOWER,
                      upper: timedelta = ORDER_UPPER, delay: str = IN_ORDER) -> DataFrame:
    """Orders with their details created within the bounds, not yet enriched.

    Fields the record has but the join does not fill (expire_time, operate_time,
    split_feight_fee) are NULL.  The event time ``create_at`` is the order's.
    """
    extra = [c for c in orders.columns if c.startswith(("user_", "province_")) and c not in ORDER_FIELDS]
    o = _timed(order_times(orders), "create_time", "create_at", delay).select(
        F.col("id").alias("order_id"), *ORDER_FIELDS, *extra, "create_at")
    d = _timed(details, "create_time", "detail_ts", delay).select(
        F.col("id").alias("detail_id"), F.col("order_id").alias("detail_order_id"), *DETAIL_FIELDS, "detail_ts")
    pairs = interval_join(o, d, "order_id", "detail_order_id", "create_at", "detail_ts", lower, upper)
    return (
        pairs.drop("detail_order_id", "detail_ts")
        .withColumn("expire_time", F.lit(None).cast("string"))
        .withColumn("operate_time", F.lit(None).cast("string"))
        .withColumn("split_feight_fee", F.lit(None).cast(MONEY))
    )


def with_user(df: DataFrame, user: DataFrame, as_of, how: str = "inner") -> DataFrame:
    """Add age and gender by user_id."""
    joined = dim_join(df, user, "user_id", {"user_birthday": "birthday", "user_gender": "gender"}, how)
    return joined.withColumn("user_age", age_years("user_birthday", as_of)).drop("user_birthday")


def with_user_as_of(df: DataFrame, versions: DataFrame, as_of, how: str = "inner", time: str = "create_at") -> DataFrame:
    """Add age and gender of the user as they were at the record's time, from versions with the time each became valid."""
    joined = as_of_join(df, versions, "user_id", time, {"user_birthday": "birthday", "user_gender": "gender"}, how)
    return joined.withColumn("user_age", age_years("user_birthday", as_of)).drop("user_birthday")


def with_province(df: DataFrame, province: DataFrame, how: str = "inner") -> DataFrame:
    return dim_join(df, province, "province_id", {
        "province_name": "name", "province_area_code": "area_code",
        "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2",
    }, how)


def with_product(df: DataFrame, product: DataFrame, how: str = "inner", price: bool = False) -> DataFrame:
    """Add SKU name, SPU, brand and category (ids as numbers) by sku_id, and the SKU price on request."""
    columns = {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id",
               "spu_name": "spu_name", "tm_name": "tm_name", "category3_name": "category3_name"}
    if price:
        columns["sku_price"] = "price"
    out = dim_join(df, product, "sku_id", columns, how)
    for c in ("spu_id", "tm_id", "category3_id"):
        out = out.withColumn(c, F.col(c).cast("bigint"))
    return out.withColumn("sku_price", F.col("sku_price").cast(MONEY)) if price else out


def placed(orders: DataFrame, dims: Dims, as_of, how: str = "inner") -> DataFrame:
    """Orders with what hangs on them, their user and province."""
    return with_province(with_user(orders, dims.user, as_of, how), dims.province, how)


def order_wide(orders: DataFrame, details: DataFrame, dims: Dims, as_of, lower: timedelta = ORDER_LOWER,
               upper: timedelta = ORDER_UPPER, how: str = "inner", delay: str = IN_ORDER) -> DataFrame:
    """Order details with their order, user, province and product.

    What hangs on the order is joined before the order meets its details, while
    there are fewer and narrower rows; the product tables come as one join.
    """
    pairs = join_order_detail(placed(orders, dims, as_of, how), details, lower, upper, delay)
    return with_product(pairs, dims.product(how), how)


def merge_order_wide(left: DataFrame, right: DataFrame, key: str = "detail_id", how: str = "left") -> DataFrame:
    """Fill NULL fields of ``left`` from the row of the same key in ``right``.

    The three split amounts are never filled, nor are fields outside the list.
    """
    # The fields that are filled.
    fill = [
        "order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
        "original_total_amount", "feight_fee", "total_amount", "user_id", "sku_id", "sku_name", "order_price",
        "sku_num",
    ]
    fill = [c for c in fill if c in left.columns and c in right.columns]
    other = right.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_r_{c}") for c in fill])
    joined = left.join(other, F.col(key) == F.col("_k"), how)
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in fill else F.col(c) for c in left.columns])


# What a wide payment takes over from the wide order.
WIDE_FIELDS = [
    "detail_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee", "split_feight_fee",
    "split_activity_amount", "split_coupon_amount", "split_total_amount", "province_name", "province_area_code",
    "province_iso_code", "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id", "category3_id",
    "spu_name", "tm_name", "category3_name",
]


def payment_wide(payments: DataFrame, wide: DataFrame, lower: timedelta = PAY_LOWER,
                 upper: timedelta = PAY_UPPER, delay: str = IN_ORDER,
                 arrival: str | None = None) -> DataFrame:
    """Payments with the wide rows of their order created within the bounds.

    Order id, user and total come from the payment, the rest from the wide row.
    ``arrival`` names a column whose time stands in for an unreadable one.  The
    event time ``payment_create_at`` is the payment's.
    """
    def timed(df: DataFrame, name: str) -> DataFrame:
        when = moment(df, "create_time")
        if arrival and arrival in df.columns:
            when = F.coalesce(when, F.col(arrival))
        out = df.withColumn(name, when)
        return out.withWatermark(name, delay) if df.isStreaming else out

    p = timed(payments, "payment_create_at").select(
        F.col("id").alias("payment_id"), "order_id", "user_id", "total_amount", "subject", "payment_type",
        F.col("create_time").alias("payment_create_time"), "callback_time",
        "payment_create_at")
    w = timed(wide, "wide_ts")
    have = [c for c in WIDE_FIELDS if c in w.columns]
    w = w.select(F.col("order_id").alias("wide_order_id"), F.col("create_time").alias("order_create_time"),
                 *have, "wide_ts")
    pairs = interval_join(p, w, "order_id", "wide_order_id", "payment_create_at", "wide_ts", lower, upper)
    return pairs.drop("wide_order_id", "wide_ts")
