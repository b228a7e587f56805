"""Record schemas of the warehouse layers."""

from __future__ import annotations

from pyspark.sql import types as T


S, L, MONEY, TEXTS = T.StringType(), T.LongType(), T.DecimalType(16, 2), T.MapType(T.StringType(), T.StringType())


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Field names and types of the records.
PAGE_LOG = record(
    common=record(mid=S, vc=S, ch=S, ar=S, is_new=S),
    page=record(page_id=S, last_page_id=S, item=S, item_type=S, during_time=L),
    displays=T.ArrayType(record(item=S, item_type=S)),
    start=S,
    ts=L,
)

CHANGE = record(database=S, tableName=S, before=TEXTS, after=TEXTS, type=S)
ROUTING = record(sourceTable=S, operateType=S, sinkType=S, sinkTable=S, sinkColumns=S, sinkPk=S, sinkExtend=S)

ORDER_INFO = record(
    id=L, province_id=L, order_status=S, user_id=L, total_amount=MONEY, activity_reduce_amount=MONEY,
    coupon_reduce_amount=MONEY, original_total_amount=MONEY, feight_fee=MONEY, expire_time=S, create_time=S,
    operate_time=S,
)
ORDER_DETAIL = record(
    id=L, order_id=L, sku_id=L, order_price=MONEY, sku_num=L, sku_name=S, create_time=S, split_total_amount=MONEY,
    split_activity_amount=MONEY, split_coupon_amount=MONEY,
)
PAYMENT_INFO = record(
    id=L, order_id=L, user_id=L, total_amount=MONEY, subject=S, payment_type=S, create_time=S, callback_time=S,
)
CART_INFO = record(sku_id=L, create_time=S)
FAVOR_INFO = CART_INFO
REFUND_INFO = record(order_id=L, sku_id=L, refund_amount=MONEY, create_time=S)
COMMENT_INFO = record(sku_id=L, appraise=S, create_time=S)

# Column order of the stats tables, which positional sinks rely on.
VISITOR_STATS = [
    "stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts",
]
PRODUCT_STATS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
    "order_amount", "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct", "refund_amount",
    "comment_ct", "good_comment_ct", "ts",
]
PROVINCE_STATS = [
    "stt", "edt", "province_id", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "order_amount", "order_count", "ts",
]
