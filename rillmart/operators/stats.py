"""Ten-second statistics: visitors, products, provinces, keywords.

All sums are pre-aggregated on the map side.  Distinct order counts are exact
and go over (group, order) first and the group second, so a very busy group is
spread over its orders; the same two steps run on streams, where a direct
distinct count is not allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes, schemas
from ..functions.numbers import MONEY
from ..functions.text import explode_words
from ..functions.timefns import event_time, moment, stamp, to_millis
from .segment import words_of
from .wide import Dims, with_product

WINDOW = "10 seconds"


def _watermarked(df: DataFrame, delay: str | None, column: str = "rt") -> DataFrame:
    """With a watermark on streams; no delay means that there is one already."""
    return df.withWatermark(column, delay) if df.isStreaming and delay else df


def _bounds() -> list[Column]:
    return [stamp("window.start").alias("stt"), stamp("window.end").alias("edt")]


# --- visitors ---------------------------------------------------------------

def _visitor_shape(log: DataFrame, **counts: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    measures = {m: zero for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")}
    measures.update(counts)
    return log.select(
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("is_new"), "ts", event_time("ts").alias("rt"),
        *[c.cast("bigint").alias(m) for m, c in measures.items()])


def visitor_rows(pages: DataFrame, unique_visits: DataFrame, jumps: DataFrame) -> DataFrame:
    """Page views, unique visits and bounces in one shape; an entry page counts as a visit."""
    return (
        _visitor_shape(
            pages, pv_ct=F.lit(1), sv_ct=F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0),
            dur_sum=F.coalesce("page.during_time", F.lit(0)))
        .unionByName(_visitor_shape(unique_visits, uv_ct=F.lit(1)))
        .unionByName(_visitor_shape(jumps, uj_ct=F.lit(1)))
    )


def visitor_stats(pages: DataFrame, unique_visits: DataFrame, jumps: DataFrame, window: str = WINDOW,
                  delay: str = "14 seconds") -> DataFrame:
    """Visitor counts per window, version, channel, area and new flag."""
    rows = _watermarked(visitor_rows(pages, unique_visits, jumps), delay)
    sums = [F.sum(m).alias(m) for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")]
    return (
        rows.groupBy(F.window("rt", window), "vc", "ch", "ar", "is_new")
        .agg(*sums, F.min("ts").alias("ts"))
        .select(*_bounds(), *schemas.VISITOR_STATS[2:])
    )


# --- products ---------------------------------------------------------------

COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"]
AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
ORDER_KINDS = {"order_ct": "order", "paid_order_ct": "paid", "refund_order_ct": "refund"}


def _product_shape(df: DataFrame, sku: Column, ts: Column, kind: str | None = None,
                   order_id: Column | None = None, **measures: Column) -> DataFrame:
    """Common product row.  ``kind`` and ``order_id`` carry an order to be counted once."""
    none = F.lit(None)
    cols = [measures.get(m, F.lit(0)).cast("bigint").alias(m) for m in COUNTS]
    cols += [measures.get(m, F.lit(0)).cast(MONEY).alias(m) for m in AMOUNTS]
    return df.select(
        sku.cast("bigint").alias("sku_id"), to_millis(ts).alias("ts"), ts.alias("rt"),
        F.lit(kind).cast("string").alias("kind"),
        (none if order_id is None else order_id).cast("bigint").alias("oid"), *cols)


def product_rows(pages: DataFrame | None = None, favor: DataFrame | None = None, cart: DataFrame | None = None,
                 orders: DataFrame | None = None, payments: DataFrame | None = None,
                 refunds: DataFrame | None = None, comments: DataFrame | None = None) -> DataFrame:
    """Clicks, displays, favors, carts, orders, payments, refunds and comments in one shape."""
    one = F.lit(1)
    sku = F.col("sku_id")
    parts = []
    if pages is not None:
        clicked = pages.filter(
            F.col("page.page_id").eqNullSafe("good_detail") & F.col("page.item_type").eqNullSafe("sku_id"))
        parts.append(_product_shape(clicked, F.col("page.item").try_cast("bigint"), event_time("ts"), click_ct=one))
        shown = pages.select("ts", F.explode("displays").alias("d")).filter(
            F.col("d.item_type").eqNullSafe("sku_id"))
        parts.append(_product_shape(shown, F.col("d.item").try_cast("bigint"), event_time("ts"), display_ct=one))
    if favor is not None:
        parts.append(_product_shape(favor, sku, moment(favor, "create_time"), favor_ct=one))
    if cart is not None:
        parts.append(_product_shape(cart, sku, moment(cart, "create_time"), cart_ct=one))
    if orders is not None:
        parts.append(_product_shape(orders, sku, moment(orders, "create_time"), "order", F.col("order_id"),
                                    order_sku_num=F.col("sku_num"), order_amount=F.col("split_total_amount")))
    if payments is not None:
        parts.append(_product_shape(payments, sku, moment(payments, "payment_create_time"), "paid", F.col("order_id"),
                                    payment_amount=F.col("split_total_amount")))
    if refunds is not None:
        parts.append(_product_shape(refunds, sku, moment(refunds, "create_time"), "refund", F.col("order_id"),
                                    refund_amount=F.col("refund_amount")))
    if comments is not None:
        good = F.when(F.col("appraise").eqNullSafe(codes.APPRAISE_GOOD), 1).otherwise(0)
        parts.append(_product_shape(comments, sku, moment(comments, "create_time"),
                                    comment_ct=one, good_comment_ct=good))
    return reduce(DataFrame.unionByName, parts)


def _amounts() -> list[Column]:
    return [F.sum(m).cast("decimal(26,2)").alias(m) for m in AMOUNTS]


def order_sums(rows: DataFrame, window: str, *also: str) -> DataFrame:
    """Sums per window, SKU, kind and order (and ``also``), where each order leaves one row; ``last`` is the latest event time."""
    keys = [F.window("rt", window).alias("window"), "sku_id", "kind", "oid", *also]
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in COUNTS], *_amounts(), F.min("ts").alias("ts"), F.max("rt").alias("last"))


def order_sums_again(parts: DataFrame) -> DataFrame:
    """Such sums added up."""
    return parts.groupBy("window", "sku_id", "kind", "oid").agg(
        *[F.sum(m).alias(m) for m in COUNTS], *_amounts(), F.min("ts").alias("ts"), F.max("last").alias("last"))


def sums_of_orders(per_order: DataFrame) -> DataFrame:
    """Sums per window and SKU of those per order, which are counted."""
    orders = [F.count(F.when(F.col("kind") == kind, F.col("oid"))).alias(name) for name, kind in ORDER_KINDS.items()]
    return (
        per_order.groupBy("window", "sku_id").agg(*[F.sum(m).alias(m) for m in COUNTS], *_amounts(), *orders, F.min("ts").alias("ts"))
        .select(*_bounds(), "sku_id", *COUNTS, *AMOUNTS, *ORDER_KINDS, "ts")
    )


def product_stats(rows: DataFrame, window: str = WINDOW, delay: str | None = "2 seconds") -> DataFrame:
    """Product counts and amounts per window and SKU, before the product names.

    First per (window, SKU, kind, order), where each order leaves one row, then
    per (window, SKU), where those rows are counted.
    """
    return sums_of_orders(order_sums(_watermarked(rows, delay), window).drop("last"))


def merge_product_stats(parts: DataFrame) -> DataFrame:
    """Statistics of single sources added up; exact for the order counts too, as each kind of order is one source's."""
    sums = [F.sum(m).alias(m) for m in (*COUNTS, *ORDER_KINDS)] + [F.sum(m).cast("decimal(26,2)").alias(m) for m in AMOUNTS]
    return parts.groupBy("stt", "edt", "sku_id").agg(*sums, F.min("ts").alias("ts")).select(
        "stt", "edt", "sku_id", *COUNTS, *AMOUNTS, *ORDER_KINDS, "ts")


def product_stats_wide(stats: DataFrame, dims: Dims, how: str = "inner") -> DataFrame:
    """Product statistics with SKU, SPU, brand and category names, in table order.

    The names are joined after aggregating, when there is one row per SKU and window.
    """
    return with_product(stats, dims.product(how), how, price=True).select(*schemas.PRODUCT_STATS)


# --- provinces --------------------------------------------------------------

# The SQL form; {window} is the window length.  Orders are counted once each.
PROVINCE_SQL = """
select date_format(window.start, 'yyyy-MM-dd HH:mm:ss') as stt,
       date_format(window.end, 'yyyy-MM-dd HH:mm:ss') as edt,
       province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       sum(amount) as order_amount, count(order_id) as order_count, min(ts) as ts
from (
  select window(rt, '{window}') as window, province_id, province_name, province_area_code, province_iso_code,
         province_3166_2_code, order_id, sum(cast(split_total_amount as decimal(16,2))) as amount,
         min(unix_millis(rt)) as ts
  from {{wide}}
  group by window(rt, '{window}'), province_id, province_name, province_area_code, province_iso_code,
           province_3166_2_code, order_id
)
group by window, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code
"""


def province_stats(wide: DataFrame, window: str = WINDOW, delay: str = "2 seconds") -> DataFrame:
    """Order amount and number of distinct orders per window and province."""
    timed = _watermarked(wide.withColumn("rt", moment(wide, "create_time")), delay)
    return wide.sparkSession.sql(PROVINCE_SQL.format(window=window), wide=timed).select(*schemas.PROVINCE_STATS)


def province_rows(wide: DataFrame) -> DataFrame:
    """Single order-wide rows in the shape of the province table, counting one order each."""
    return wide.select(
        F.lit("").alias("stt"), F.lit("").alias("edt"), "province_id", "province_name", "province_area_code",
        "province_iso_code", "province_3166_2_code", F.col("split_total_amount").alias("order_amount"),
        F.lit(1).cast("bigint").alias("order_count"),
        to_millis(moment(wide, "create_time")).alias("ts"))


# --- keywords ---------------------------------------------------------------

def searches(pages: DataFrame, item_type: str | None = None) -> DataFrame:
    """Search texts (keywords, rt): pages reached from the search page, with an item."""
    found = pages.filter((F.col("page.last_page_id") == "search") & F.col("page.item").isNotNull())
    if item_type:
        found = found.filter(F.col("page.item_type") == item_type)
    return found.select(F.col("page.item").alias("keywords"), event_time("ts").alias("rt"))


def keyword_stats(search: DataFrame, window: str = WINDOW, delay: str = "2 seconds", source: str = "search",
                  han_pairs: bool = False, stop_words: DataFrame | None = None, tokenizer=None) -> DataFrame:
    """How often each word was searched for per window."""
    split = explode_words(_watermarked(search, delay), "keywords", "keyword", han_pairs, stop_words, tokenizer)
    return (
        split.groupBy(F.window("rt", window), "keyword")
        .agg(F.count(F.lit(1)).alias("ct"), F.min(F.unix_millis("rt")).alias("ts"))
        .select("keyword", "ct", F.lit(source).alias("source"), *_bounds(), "ts")
    )


def keyword_stats_by_dictionary(search: DataFrame, dictionary: DataFrame, mode: str = "all", window: str = WINDOW, source: str = "search") -> DataFrame:
    """How often each word by a dictionary (``segment``) was searched for per window; a batch plan.

    Searches are counted per window and text first, so a text that everybody searches for is one row per window
    when it meets its words.
    """
    asked = search.groupBy(F.window("rt", window).alias("window"), "keywords").agg(F.count(F.lit(1)).alias("asked"), F.min(F.unix_millis("rt")).alias("ts"))
    found = words_of(search, "keywords", dictionary, mode)
    return (
        asked.join(found, "keywords").groupBy("window", F.col("word").alias("keyword"))
        .agg(F.sum(F.col("asked") * F.col("times")).alias("ct"), F.min("ts").alias("ts"))
        .select("keyword", "ct", F.lit(source).alias("source"), *_bounds(), "ts")
    )
