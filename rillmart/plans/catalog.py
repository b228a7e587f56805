"""Every query by name: (spark, folder of tables) -> DataFrame.

All queries read whole tables.  Windows and time bounds are wider than the
defaults because the tables' events lie hours and days apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import codes, schemas
from ..functions import timefns as tf
from ..operators import logs, order_sets, parsing, reports, routing, stats, visits, wide
from ..operators.joins import interval_join
from ..operators.upsert import as_text, upsert
from ..session import new_folder, use_utc
from ..sinks import buckets, days, dims as dim_sink, history, ledger
from ..sinks.kept import kept_table
from ..sinks.stats import with_dt
from ..sinks.topics import json_topic, tee, to_routed_topics
from ..sources import changes, testbed as tb, topics
from ..sources.tables import lookup, read_table, stream_table
from ..streaming import refresh, stateful
from ..streaming.jobs import Replay, Stages
from ..streaming.refresh import keep_running
from . import layers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY_WINDOW = "1 day"
HOUR_WINDOW = "1 hour"
ORDER_WINDOW = "30 days"
VISITOR_DATE = 20240105
ORDER_DATE = 19980504  # start of a 30-day window
ORDER_BOUNDS = (tb.ORDER_LOWER, tb.ORDER_UPPER)
PAY_BOUNDS = (tb.PAY_LOWER, tb.PAY_UPPER)
# How long a wide order waits for its details, and a wide payment for its wide order.
WIDE_DELAY, PAID_DELAY = "5 days", "10 days"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def plain(df: DataFrame, *leave_out: str) -> DataFrame:
    """Amounts as doubles, for results compared with other engines."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(c).cast("double").alias(c) if kinds[c].startswith("decimal") else F.col(c)
                       for c in df.columns if c not in leave_out])


def flat_log(log: DataFrame, *more: str) -> DataFrame:
    return log.select("event_id", "common.*", "page.*", "ts", *more)


def short_log(log: DataFrame, *more: str) -> DataFrame:
    return log.select("event_id", "common.mid", "common.is_new", "page.page_id", "ts", *more)


# --- parsing and change records ----------------------------------------------

@query
def parse_dirty_split(spark, sf):
    """JSON log lines parsed, unreadable ones told apart."""
    marked = parsing.parse_marked(tb.log_lines(tb.app_log(spark, sf)), schemas.PAGE_LOG, ("common.mid", "ts"))
    ok = ~F.col("dirty")
    return marked.select(
        "event_id", F.col("dirty").cast("int").alias("dirty"), F.when(ok, F.col("common.mid")).alias("mid"),
        F.when(ok, F.col("page.page_id")).alias("page_id"), F.when(ok, F.col("page.item")).alias("item"),
        F.when(ok, F.coalesce(F.size("displays"), F.lit(0))).alias("n_displays"),
        F.when(ok, F.col("start")).alias("start"), F.when(ok, F.col("ts")).alias("ts"))


@query
def json_roundtrip(spark, sf):
    """Order records written as JSON lines and read back typed."""
    lines = parsing.to_json_lines(tb.order_info(spark, sf).drop("create_at"))
    return plain(parsing.parse_lines(lines, schemas.ORDER_INFO, ("id",))[0])


def _open_log(spark, sf) -> DataFrame:
    return parsing.parse_marked(tb.open_log_lines(tb.app_log(spark, sf)), schemas.PAGE_LOG, ("common.mid", "ts"))


@query
def open_parse_split(spark, sf):
    """Log lines with fields of their own, quoted numbers and decimals: what is read, and what is dirty."""
    marked = _open_log(spark, sf)
    ok = ~F.col("dirty")
    return marked.select("event_id", F.col("dirty").cast("int").alias("dirty"), F.when(ok, F.col("common.mid")).alias("mid"),
                         F.when(ok, F.col("page.during_time")).alias("during_time"), F.when(ok, F.col("ts")).alias("ts"))


@query
def open_log_topics(spark, sf):
    """Such lines split into topics with repaired flags: every field of a record is handed on."""
    log = _open_log(spark, sf).filter(~F.col("dirty")).drop("dirty")
    out = logs.routed_whole(logs.repair_new_flag(log))
    field = lambda path: F.get_json_object("value", path)
    return out.select(
        "event_id", "sink_table", field("$.common.is_new").alias("is_new"), field("$.common.md").alias("md"),
        field("$.page.source_type").alias("source_type"), field("$.err.code").cast("bigint").alias("err_code"),
        field("$.start.loading_time").cast("bigint").alias("loading_time"), field("$.pos_id").cast("bigint").alias("pos_id"),
        field("$.page_id").alias("shown_on"), field("$.item").alias("item"), field("$.page.during_time").alias("during_text"))


def _key(image: Column) -> Column:
    return F.coalesce(image["c_custkey"], image["o_orderkey"], image["p_partkey"], image["s_suppkey"]).cast("bigint")


@query
def cdc_normalize(spark, sf):
    """Change records in the common envelope."""
    env = parsing.change_envelope(tb.change_records(spark, sf))
    return env.select(
        "database", F.col("tableName").alias("table_name"), "type", F.size("before").alias("n_before"),
        F.size("after").alias("n_after"), F.coalesce(_key(F.col("after")), _key(F.col("before"))).alias("key"),
        F.col("after")["c_mktsegment"].alias("segment"))


@query
def cdc_flat(spark, sf):
    """Change records in the flat form."""
    flat = parsing.flat_envelope(tb.change_records(spark, sf))
    return flat.select(
        "operation", "database", F.col("table").alias("table_name"), F.size("data").alias("n_data"),
        _key(F.col("data")).alias("key"))


def _routed(spark, sf) -> DataFrame:
    env = parsing.change_envelope(tb.change_records(spark, sf))
    return routing.route_changes(env, tb.routing(spark))


@query
def cdc_route_fact(spark, sf):
    """Changes routed to fact topics, columns cut to the configured ones."""
    facts = routing.fact_changes(_routed(spark, sf))
    after = F.col("after")
    return facts.select(
        F.col("sinkTable").alias("sink_table"), "type", F.size("after").alias("n_columns"),
        after["o_orderkey"].cast("bigint").alias("o_orderkey"), after["o_custkey"].cast("bigint").alias("o_custkey"),
        after["o_totalprice"].cast("double").alias("o_totalprice"), after["o_orderdate"].alias("o_orderdate"),
        after["o_orderstatus"].alias("o_orderstatus"))


@query
def cdc_route_dim(spark, sf):
    """Changes routed to dimension tables, columns cut to the configured ones."""
    after = F.col("after")
    return routing.dim_changes(_routed(spark, sf)).select(
        F.col("sinkTable").alias("sink_table"), F.col("sinkPk").alias("sink_pk"), "type",
        F.size("after").alias("n_columns"), after["c_custkey"].cast("bigint").alias("c_custkey"),
        after["c_name"].alias("c_name"), after["c_mktsegment"].alias("c_mktsegment"),
        after["c_acctbal"].alias("c_acctbal"))


DIM_COLUMNS = ["c_custkey", "c_name", "c_mktsegment"]
DIM_BUCKETS = 8


@query
def dim_upsert(spark, sf):
    """A customer table with all routed changes put in, the newest per key."""
    base = as_text(read_table(spark, sf, "customer").filter("c_acctbal >= 5000").select(
        "c_custkey", "c_name", F.lit("STALE").alias("c_mktsegment")))
    changes = routing.map_columns(routing.dim_changes(_routed(spark, sf)), "dim_customer", DIM_COLUMNS, ("seq",))
    return upsert(base, changes, "c_custkey", "seq")


@query
def dim_upsert_buckets(spark, sf):
    """The same table dealt into hash buckets; each batch of changes reads and rewrites the buckets of its keys."""
    path = new_folder(spark, "dim-buckets")
    base = as_text(read_table(spark, sf, "customer").filter("c_acctbal >= 5000").select(
        "c_custkey", "c_name", F.lit("STALE").alias("c_mktsegment")))
    buckets.make_table(base, path, "c_custkey", DIM_BUCKETS)
    routed = routing.map_columns(routing.dim_changes(_routed(spark, sf)), "dim_customer", DIM_COLUMNS, ("seq",))
    for n, seq in enumerate((1, 2)):  # inserts, then updates; deletes are not routed
        buckets.apply_changes(routed.filter(F.col("seq") == seq), path, n, "seq")
    return buckets.read_table(spark, path)


# --- app log ------------------------------------------------------------------

@query
def new_flag_repair(spark, sf):
    """The new-visitor flag of every log record after the repair."""
    return logs.repair_new_flag(tb.app_log(spark, sf)).select("event_id", "common.mid", "common.is_new", "ts")


@query
def log_split_page(spark, sf):
    return flat_log(logs.page_log(tb.app_log(spark, sf)))


@query
def log_split_start(spark, sf):
    return flat_log(logs.start_log(tb.app_log(spark, sf)), "start")


@query
def log_split_display(spark, sf):
    return logs.display_log(tb.app_log(spark, sf))


@query
def log_routed_topics(spark, sf):
    """Records per topic when the log is split in one pass."""
    return logs.routed_log(tb.app_log(spark, sf)).groupBy("sink_table").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.when(F.get_json_object("value", "$.item_type") == "sku_id", 1).otherwise(0)).alias("sku_records"))


@query
def unique_visit(spark, sf):
    return short_log(visits.unique_visit(tb.app_log(spark, sf)))


@query
def user_jump_detail(spark, sf):
    return short_log(visits.user_jump(tb.app_log(spark, sf), tb.BOUNCE_WITHIN))


@query
def user_jump_matched(spark, sf):
    return short_log(visits.user_jump(tb.app_log(spark, sf), tb.BOUNCE_WITHIN, fates=("matched",)))


@query
def user_jump_timeout(spark, sf):
    return short_log(visits.user_jump(tb.app_log(spark, sf), tb.BOUNCE_WITHIN, fates=("timeout",)))


# --- wide records -------------------------------------------------------------

def _pairs(spark, sf) -> DataFrame:
    return wide.join_order_detail(tb.order_info(spark, sf), tb.order_detail(spark, sf), *ORDER_BOUNDS)


ORDER_TABLES = ("orders", "lineitem", "customer", "nation", "region", "part")


def _order_wide(spark, sf) -> DataFrame:
    return wide.order_wide(tb.order_info(spark, sf), tb.order_detail(spark, sf), layers.dims_from(spark, sf),
                           tb.AS_OF, *ORDER_BOUNDS)


def _kept_order_wide(spark, sf) -> DataFrame:
    """Wide orders as a table, as the streams hand them on: what is built on them reads them instead of joining again."""
    return kept_table(spark, sf, "dwm_order_wide", ORDER_TABLES, lambda: _order_wide(spark, sf), settings=ORDER_BOUNDS)


def _payment_wide(spark, sf) -> DataFrame:
    return wide.payment_wide(tb.payment_info(spark, sf), _kept_order_wide(spark, sf), *PAY_BOUNDS)


@query
def order_interval_join(spark, sf):
    """Orders with the details created within five days of them."""
    return plain(_pairs(spark, sf).select(
        "order_id", "detail_id", "sku_id", "sku_num", "user_id", "province_id", "order_status", "create_time",
        "create_date", "create_hour", "total_amount", "split_total_amount"))


@query
def payment_interval_join(spark, sf):
    """Payments with the order details their order was created with."""
    return plain(wide.payment_wide(tb.payment_info(spark, sf), _pairs(spark, sf), *PAY_BOUNDS).select(
        "payment_id", "order_id", "detail_id", "sku_id", "payment_type", "payment_create_time", "order_create_time",
        "total_amount", "split_total_amount"))


@query
def order_shipment_window(spark, sf):
    """Orders with the details shipped 30 to 90 days after them, a dense interval join."""
    from datetime import timedelta

    o = tb.order_info(spark, sf).select(F.col("id").alias("order_id"), F.col("create_at").alias("o_ts"))
    d = tb.order_detail(spark, sf).select(
        F.col("order_id").alias("d_order_id"), "sku_id", "split_total_amount", F.col("create_at").alias("d_ts"))
    pairs = interval_join(o, d, "order_id", "d_order_id", "o_ts", "d_ts", timedelta(days=30), timedelta(days=90))
    return plain(pairs.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("details"), F.sum("split_total_amount").alias("amount")))


@query
def order_wide(spark, sf):
    return plain(_order_wide(spark, sf), "create_at", "expire_time", "operate_time", "split_feight_fee")


@query
def payment_wide(spark, sf):
    return plain(_payment_wide(spark, sf), "payment_create_at", "split_feight_fee")


@query
def order_wide_merge(spark, sf):
    """Wide rows whose order fields are partly missing, filled from the orders."""
    pairs = _pairs(spark, sf)
    hurt = F.col("order_status") == "F"
    for c in ("create_time", "total_amount", "user_id"):
        pairs = pairs.withColumn(c, F.when(~hurt, F.col(c)))
    orders = wide.order_times(tb.order_info(spark, sf)).withColumnRenamed("id", "order_id").withColumn(
        "order_status", F.lit("X"))
    merged = wide.merge_order_wide(pairs, orders, "order_id")
    return plain(merged.select("order_id", "detail_id", "order_status", "create_time", "total_amount", "user_id",
                               "split_total_amount"))


@query
def province_rows(spark, sf):
    """Order-wide rows in the shape of the province table."""
    return plain(stats.province_rows(_order_wide(spark, sf)))


# --- statistics ---------------------------------------------------------------

def _visitor_stats(spark, sf, window: str) -> DataFrame:
    return layers.visitor_stats(tb.app_log(spark, sf), tb.BOUNCE_WITHIN, window)


def _product_stats(spark, sf, window: str) -> DataFrame:
    rows = stats.product_rows(
        logs.page_log(tb.app_log(spark, sf)), tb.favor_info(spark, sf), tb.cart_info(spark, sf), _kept_order_wide(spark, sf),
        _payment_wide(spark, sf), tb.refund_info(spark, sf), tb.comment_info(spark, sf))
    return stats.product_stats(rows, window)


def _product_wide(spark, sf, window: str = ORDER_WINDOW) -> DataFrame:
    return stats.product_stats_wide(_product_stats(spark, sf, window), layers.dims_from(spark, sf))


def _province_stats(spark, sf) -> DataFrame:
    return stats.province_stats(_kept_order_wide(spark, sf), ORDER_WINDOW)


def _middle(df: DataFrame, time: str):
    """The middle of a table's span of time."""
    low, high = df.agg(F.min(time), F.max(time)).first()
    return None if low is None else low + (high - low) / 2


def _keyword_stats(spark, sf) -> DataFrame:
    return stats.keyword_stats(stats.searches(tb.app_log(spark, sf)), DAY_WINDOW)


# Reports read stats tables, which are partitioned by day.

def _product_table(spark, sf) -> DataFrame:
    return kept_table(spark, sf, "product_stats", (*ORDER_TABLES, "events"), lambda: _product_wide(spark, sf), by_day=True,
                      settings=(ORDER_WINDOW, *ORDER_BOUNDS, *PAY_BOUNDS))


def _province_table(spark, sf) -> DataFrame:
    return kept_table(spark, sf, "province_stats", ORDER_TABLES, lambda: _province_stats(spark, sf), by_day=True,
                      settings=(ORDER_WINDOW, *ORDER_BOUNDS))


def _visitor_table(spark, sf, window: str) -> DataFrame:
    return kept_table(spark, sf, f"visitor_stats_{window.replace(' ', '_')}", ("events",), lambda: _visitor_stats(spark, sf, window), by_day=True,
                      settings=(window, tb.BOUNCE_WITHIN))


def _keyword_table(spark, sf) -> DataFrame:
    return kept_table(spark, sf, "keyword_stats", ("events",), lambda: _keyword_stats(spark, sf), by_day=True, settings=(DAY_WINDOW,))


@query
def visitor_stats(spark, sf):
    return _visitor_stats(spark, sf, DAY_WINDOW)


@query
def visitor_stats_10s(spark, sf):
    """Visitor statistics with the default ten-second window."""
    return _visitor_stats(spark, sf, stats.WINDOW)


@query
def product_stats(spark, sf):
    return plain(_product_stats(spark, sf, ORDER_WINDOW))


@query
def product_stats_wide(spark, sf):
    return plain(_product_wide(spark, sf))


@query
def product_stats_all_lines(spark, sf):
    """Product statistics over every order line and every refund, a dense distinct count of orders."""
    lines = tb.order_detail(spark, sf)
    rows = stats.product_rows(orders=lines, refunds=tb.refund_info(spark, sf))
    return plain(stats.product_stats(rows, ORDER_WINDOW).select(
        "stt", "edt", "sku_id", "order_sku_num", "order_amount", "order_ct", "refund_order_ct", "refund_amount"))


def _order_set_table(spark, sf) -> DataFrame:
    """The orders and refunds of every line as sets by day and SKU; ``dt`` is a sorted column, as a folder for each of these days would hold a few rows."""
    rows = stats.product_rows(orders=tb.order_detail(spark, sf), refunds=tb.refund_info(spark, sf))
    return kept_table(spark, sf, "order_sets", ("lineitem",), lambda: with_dt(order_sets.order_sets(rows)).sortWithinPartitions("dt"),
                      settings=(DAY_WINDOW, order_sets.MOST_LISTED))


def _by_month(sets: DataFrame) -> DataFrame:
    return sets.withColumn("month", F.floor(F.col("dt") / 100).cast("int"))


@query
def product_orders_by_month(spark, sf):
    """Distinct orders per month and SKU, from stored sets by day."""
    return order_sets.distinct_orders(_by_month(_order_set_table(spark, sf)), ["month", "sku_id"]).drop("paid_order_ct")


@query
def brand_orders_by_month(spark, sf):
    """Distinct orders per month and brand from the sets by day and SKU; several products of a brand in an order are one order."""
    brands = tb.dim_sku(spark, sf).select(F.col("id").cast("bigint").alias("sku_id"), F.col("tm_id").cast("bigint").alias("tm_id"))
    sets = _by_month(_order_set_table(spark, sf)).join(brands, "sku_id")
    return order_sets.distinct_orders(sets, ["month", "tm_id"]).drop("paid_order_ct")


@query
def province_stats(spark, sf):
    return plain(_province_stats(spark, sf))


@query
def keyword_stats(spark, sf):
    return _keyword_stats(spark, sf)


def _dictionary_stats(spark, sf, mode: str) -> DataFrame:
    found = tb.named_searches(spark, sf)
    return stats.keyword_stats_by_dictionary(found, tb.word_list(spark, sf), mode, DAY_WINDOW)


@query
def keyword_stats_dictionary(spark, sf):
    """Keyword statistics with every dictionary word at every position."""
    return _dictionary_stats(spark, sf, "all")


@query
def keyword_stats_longest(spark, sf):
    """Keyword statistics with the longest dictionary words from left to right."""
    return _dictionary_stats(spark, sf, "longest")


@query
def keyword_stats_days(spark, sf):
    """Keyword statistics kept by day while files of events arrive; each arrival rebuilds the days its records are of."""
    events = read_table(spark, sf, "events")
    folder, path = new_folder(spark, "events-in"), new_folder(spark, "keyword-days")
    arrived = days.Input("events", folder, lambda rows: F.array(tf.yyyymmdd("ts")))

    def build(changed: list[int]) -> DataFrame:
        log = tb.log_of_events(spark.read.schema(events.schema).parquet(folder).filter(days.in_days("ts", changed)), tb.number_of_skus(spark, sf))
        return stats.keyword_stats(stats.searches(log), DAY_WINDOW)

    for part in range(3):  # the last files hold records of all days
        late = F.col("event_id") % 100 == 0
        early = F.col("ts") < F.lit(_middle(events, "ts"))
        events.filter((~late & early, ~late & F.coalesce(~early, F.lit(True)), late)[part]).write.mode("append").parquet(folder)
        days.refresh(spark, path, [arrived], build, f"keywords {DAY_WINDOW}")
    return days.read_days(spark, path).drop("dt")


# --- reports ------------------------------------------------------------------

@query
def report_gmv(spark, sf):
    return reports.gmv(_product_table(spark, sf), ORDER_DATE)


@query
def report_gmv_today(spark, sf):
    """Without a date a report is about today."""
    return reports.gmv(_product_table(spark, sf), reports.today(spark))


@query
def report_gmv_by_day(spark, sf):
    return reports.gmv(_product_table(spark, sf))


@query
def report_brand(spark, sf):
    return reports.brand_gmv(_product_table(spark, sf), ORDER_DATE)


@query
def report_brand_by_day(spark, sf):
    return reports.brand_gmv(_product_table(spark, sf))


@query
def report_brand_all(spark, sf):
    return reports.brand_gmv_all(_product_table(spark, sf), ORDER_DATE)


@query
def report_brand_series(spark, sf):
    """The brand ranking as one row of two lists."""
    top = reports.brand_gmv(_product_table(spark, sf), ORDER_DATE)
    lists = reports.series(top, "tm_name", "order_amount")
    amounts = F.transform("series", lambda v: v.cast("decimal(16,2)").cast("string"))
    return lists.select(  # a day without turnover has no lists
        F.nullif(F.array_join("categories", ","), F.lit("")).alias("categories"),
        F.nullif(F.array_join(amounts, ","), F.lit("")).alias("series"))


@query
def report_category3(spark, sf):
    return reports.category3_gmv(_product_table(spark, sf), ORDER_DATE)


@query
def report_category3_by_day(spark, sf):
    return reports.category3_gmv(_product_table(spark, sf))


@query
def report_spu(spark, sf):
    return reports.spu_gmv(_product_table(spark, sf), ORDER_DATE)


@query
def report_spu_by_day(spark, sf):
    return reports.spu_gmv(_product_table(spark, sf))


@query
def report_province(spark, sf):
    return reports.name_value(reports.province_gmv(_province_table(spark, sf), ORDER_DATE),
                              "province_name", "order_amount")


@query
def report_province_by_day(spark, sf):
    return reports.province_gmv(_province_table(spark, sf))


@query
def report_visitor_new(spark, sf):
    """Visitors by new flag for every day, with ratios."""
    return reports.with_ratios(reports.visitors_by_new(_visitor_table(spark, sf, DAY_WINDOW)))


@query
def report_visitor_new_old(spark, sf):
    return reports.new_against_old(reports.visitors_by_new(_visitor_table(spark, sf, DAY_WINDOW), VISITOR_DATE))


@query
def report_visitor_hour(spark, sf):
    return reports.full_day(reports.visitors_by_hour(_visitor_table(spark, sf, HOUR_WINDOW), VISITOR_DATE))


@query
def report_visitor_hour_by_day(spark, sf):
    return reports.visitors_by_hour(_visitor_table(spark, sf, HOUR_WINDOW))


@query
def report_keyword(spark, sf):
    return reports.name_value(reports.keyword_scores(_keyword_table(spark, sf), VISITOR_DATE), "keyword", "ct")


@query
def report_keyword_by_day(spark, sf):
    return reports.keyword_scores(_keyword_table(spark, sf))


# --- scalar functions -----------------------------------------------------------

@query
def code_decode(spark, sf):
    """Comments with their appraise code and its name."""
    return tb.comment_info(spark, sf).select(
        "sku_id", "create_time", "appraise", codes.decode("appraise", "appraise").alias("appraise_name"))


@query
def code_counts(spark, sf):
    """How many order lines carry each code of all kinds; codes that are not listed have no name, codes not met no lines."""
    met = tb.coded_lines(spark, sf).groupBy("kind", "code", "decoded").agg(F.count(F.lit(1)).alias("lines"))
    return met.join(codes.code_table(spark), ["kind", "code"], "full").select(
        "kind", "code", "name", "decoded", F.coalesce("lines", F.lit(0)).alias("lines"))


@query
def time_functions(spark, sf):
    """Day, hour, text and epoch forms of every event time."""
    ts = F.col("ts")
    text = tf.stamp(ts)
    return read_table(spark, sf, "events").select(
        "event_id", tf.yyyymmdd(ts).alias("yyyymmdd"), tf.hour_of(ts).alias("hr"), text.alias("stamp"),
        tf.to_millis(ts).alias("millis"), tf.stamp(tf.event_time(tf.to_millis(ts))).alias("stamp_of_millis"),
        tf.to_millis(tf.parse_stamp(text)).alias("millis_of_stamp"),
        tf.to_millis(tf.parse_stamp_at(text, "+08:00")).alias("millis_at_8"),
        tf.stamp_date(text).alias("day"), tf.stamp_hour(text).alias("hour_text"),
        tf.stamp(F.to_timestamp(tf.day_of_millis(tf.to_millis(ts)))).alias("day_start"))


@query
def user_age(spark, sf):
    """Ages in 365-day years at a fixed moment."""
    return tb.dim_user(spark, sf).select(
        "id", "birthday", "gender", tf.age_years("birthday", tb.AS_OF).alias("user_age"))


# --- streams --------------------------------------------------------------------

@query
def stream_new_flag(spark, sf):
    """The flag repair with keyed state."""
    stages = Stages(spark, "new-flag")
    fixed = stateful.repair_new_flag_stream(tb.app_log_stream(stages.session, sf))
    stages.run("log", fixed.select("event_id", "common.mid", "common.is_new", "ts"))
    return stages.table("log")


def _log_stream(stages: Stages, spark, sf) -> DataFrame:
    """The app log as a stream that ends with records of a far time, so that nothing stays open."""
    return stages.ended(tb.app_log_stream(stages.session, sf), tb.log_end(spark, sf), "log")


@query
def stream_unique_visit(spark, sf):
    """The first visits of each day when the day closes."""
    stages = Stages(spark, "unique-visit")
    stages.run("visits", short_log(stateful.unique_visit_by_day_stream(_log_stream(stages, spark, sf))))
    return stages.table("visits").filter("event_id >= 0")


@query
def stream_unique_visit_live(spark, sf):
    """The first visits of each day at once, with keyed state."""
    stages = Stages(spark, "unique-visit-live")
    stages.run("visits", short_log(stateful.unique_visit_stream(tb.app_log_stream(stages.session, sf))))
    return stages.table("visits")


@query
def stream_user_jump(spark, sf):
    """Bounces decided by the time the watermark has reached."""
    stages = Stages(spark, "user-jump")
    stages.run("jumps", short_log(
        stateful.user_jump_stream(_log_stream(stages, spark, sf), tb.BOUNCE_WITHIN)))
    return stages.table("jumps").filter("event_id >= 0")


@query
def stream_visitor_stats(spark, sf):
    """The whole visitor chain on streams."""
    stages = Stages(spark, "visitor-stats")
    return layers.stream_visitor_stats(stages, _log_stream(stages, spark, sf), tb.BOUNCE_WITHIN, DAY_WINDOW)


@query
def stream_order_interval_join(spark, sf):
    stages = Stages(spark, "order-detail")
    s = stages.session
    pairs = wide.join_order_detail(tb.order_info_stream(s, sf), tb.order_detail_stream(s, sf), *ORDER_BOUNDS)
    stages.run("pairs", plain(pairs.select(
        "order_id", "detail_id", "sku_id", "sku_num", "user_id", "province_id", "order_status", "create_time",
        "create_date", "create_hour", "total_amount", "split_total_amount")))
    return stages.table("pairs")


def _stream_wide(spark, sf, label: str) -> Stages:
    stages = Stages(spark, label)
    s = stages.session
    orders, details, payments = (stages.ended(stream, last, name) for stream, last, name in zip(
        (tb.order_info_stream(s, sf), tb.order_detail_stream(s, sf), tb.payment_info_stream(s, sf)),
        tb.order_end(spark, sf), ("orders", "details", "payments"), strict=True))
    layers.stream_wide(stages, orders, details, payments, layers.dims_from(s, sf), tb.AS_OF, ORDER_BOUNDS, PAY_BOUNDS)
    return stages


@query
def stream_payment_wide(spark, sf):
    """Orders, details and payments joined on streams, dimensions looked up."""
    rows = _stream_wide(spark, sf, "payment-wide").table("dwm_payment_wide").filter("order_id >= 0")
    return plain(rows, "payment_create_at", "split_feight_fee")


@query
def stream_product_stats(spark, sf):
    """Product statistics of all seven sources over several batches, each source under its own watermark."""
    stages = Stages(spark, "product-stats")
    s = stages.session
    replay = Replay(stages, 2)
    log, orders = tb.app_log(spark, sf), tb.order_info(spark, sf)
    placed = replay.cuts(orders, "create_at")
    ends = dict(zip(("orders", "details", "payments"), tb.order_end(spark, sf), strict=True))
    streams = {name: replay.add(name, f(spark, sf), "create_at", placed, ends.get(name)) for name, f in (
        ("orders", tb.order_info), ("details", tb.order_detail), ("payments", tb.payment_info), ("favor", tb.favor_info),
        ("cart", tb.cart_info), ("refunds", tb.refund_info), ("comments", tb.comment_info))}
    pages = logs.page_log(replay.add("log", log, "ts", replay.cuts(log, "ts")))
    dims, merged = layers.dims_from(s, sf), None
    while replay.feed():
        layers.stream_wide(stages, streams["orders"], streams["details"], streams["payments"], dims, tb.AS_OF, ORDER_BOUNDS, PAY_BOUNDS,
                           WIDE_DELAY)
        if merged is None:
            merged = layers.product_sources(
                stages, ORDER_WINDOW, {"orders": WIDE_DELAY, "payments": PAID_DELAY}, pages=pages, favor=streams["favor"], cart=streams["cart"],
                orders=stages.stream("dwm_order_wide"), payments=stages.stream("dwm_payment_wide"), refunds=streams["refunds"],
                comments=streams["comments"])
        if replay.fed == replay.parts:
            for source in merged.parts:
                merged.beat(source, tb.END)
        merged.run()
    return plain(merged.table(), "dt")


@query
def stream_province_stats(spark, sf):
    stages = _stream_wide(spark, sf, "province-stats")
    stages.run("province_stats", stats.province_stats(stages.stream("dwm_order_wide"), ORDER_WINDOW))
    return plain(stages.table("province_stats"))


@query
def stream_keyword_stats(spark, sf):
    stages = Stages(spark, "keyword-stats")
    found = stats.searches(_log_stream(stages, spark, sf))
    stages.run("keyword_stats", stats.keyword_stats(found, DAY_WINDOW))
    return stages.table("keyword_stats")


def _db_split(spark, sf) -> Stages:
    """Change records of four tables routed by config into facts and dimension tables."""
    stages = Stages(spark, "db-split")
    s = stages.session
    env = parsing.change_envelope(tb.change_records(s, sf, stream_table))
    refresh.db_split(env, lambda: tb.routing(s), stages.path("facts"), stages.path("dims"), stages.checkpoint("split"),
                     "seq", once=True).awaitTermination()
    return stages


@query
def stream_dim_upsert(spark, sf):
    """Customer changes upserted into their dimension table, batch by batch."""
    stages = _db_split(spark, sf)
    return dim_sink.read_dim(spark, f"{stages.path('dims')}/dim_customer", "c_custkey").select(*DIM_COLUMNS)


@query
def stream_dim_partial(spark, sf):
    """Updates that hold a part of the columns, from operations with different column lists."""
    stages = Stages(spark, "dim-partial")
    s = stages.session
    env = parsing.change_envelope(tb.partial_change_records(s, sf, stream_table))
    refresh.db_split(env, lambda: tb.routing(s, tb.PARTIAL_ROWS), stages.path("facts"), stages.path("dims"), stages.checkpoint("split"),
                     "seq", once=True).awaitTermination()
    rows = dim_sink.read_dim(spark, f"{stages.path('dims')}/dim_customer", "c_custkey")
    return rows.select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query
def stream_route_fact(spark, sf):
    """Order changes written to their fact topic, read back."""
    stages = _db_split(spark, sf)
    lines = spark.read.schema("value string, batch int, sink_table string").text(stages.path("facts"))
    kept = lines.select("sink_table", F.from_json("value", "map<string,string>").alias("r"))
    return kept.select(
        "sink_table", F.size("r").alias("n_columns"), F.col("r")["o_orderkey"].cast("bigint").alias("o_orderkey"),
        F.col("r")["o_custkey"].cast("bigint").alias("o_custkey"),
        F.col("r")["o_totalprice"].cast("double").alias("o_totalprice"), F.col("r")["o_orderdate"].alias("o_orderdate"))


@query
def stream_log_topics(spark, sf):
    """The log split on a stream into one text folder per topic, read back."""
    stages = Stages(spark, "log-topics")
    routed = logs.routed_log(tb.app_log_stream(stages.session, sf))
    to_routed_topics(routed, stages.path("topics"), stages.checkpoint("topics"), once=True).awaitTermination()
    back = spark.read.schema("value string, sink_table string").text(stages.path("topics"))
    return back.groupBy("sink_table").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.when(F.get_json_object("value", "$.item_type") == "sku_id", 1).otherwise(0)).alias("sku_records"))


@query
def stream_topic_table(spark, sf):
    """Page records written to a topic of JSON lines, read back as a declared table and counted in SQL."""
    stages = Stages(spark, "topic-table")
    s = stages.session
    pages = logs.page_log(tb.app_log_stream(s, sf)).select("page", "ts")
    json_topic(pages, stages.path("dwd_page_log"), stages.checkpoint("dwd_page_log"), once=True).awaitTermination()
    lines = topics.file_topic(spark, stages.path("dwd_page_log"), stream=False)
    table = topics.topic_table(lines, "page map<string,string>, ts bigint", tf.event_time("ts"))
    return spark.sql("""
        select page['page_id'] as page_id, count(*) as records, count(page['item']) as with_item, min(unix_millis(rt)) as first_ts
        from {t} group by page['page_id']""", t=table)


@query
def stream_tee(spark, sf):
    """Raw log lines written to the topic and to a copy by day of arrival; both hold every line."""
    stages = Stages(spark, "tee")
    lines = tb.log_lines(tb.app_log_stream(stages.session, sf)).select("value")
    tee(lines, stages.path("ods"), stages.path("daily"), stages.checkpoint("tee"), once=True).awaitTermination()
    parts = [(where, spark.read.schema("value string").text(stages.path(where))) for where in ("ods", "daily")]
    counts = [df.agg(F.lit(where).alias("copy"), F.count(F.lit(1)).alias("lines"), F.count_if(F.col("value") == "").alias("empty")) for where, df in parts]
    return counts[0].unionByName(counts[1])


@query
def stream_snapshot_then_log(spark, sf):
    """A table's snapshot and then its change log through one stream of lines; the newest image of each row is left."""
    stages = Stages(spark, "snapshot-log")
    snapshot = changes.snapshot_records(read_table(spark, sf, "customer"), "shop", "customer").withColumn("seq", F.lit(1))
    log = tb.change_records(spark, sf).filter("topic = 'binlog.shop.customer' and op <> 'READ'").select(*snapshot.columns)
    for name, rows in (("1-snapshot", snapshot), ("2-log", log)):
        parsing.to_json_lines(rows).write.mode("append").text(stages.path("binlog"))
    stages.run("records", changes.change_lines(stages.session, stages.path("binlog"), "initial"))
    kinds = "topic string, op string, before map<string,string>, after map<string,string>, seq int"
    records = stages.table("records").select(F.from_json("value", kinds).alias("r")).select("r.*")
    env = parsing.change_envelope(records).withColumn("key", F.coalesce(F.col("after")["c_custkey"], F.col("before")["c_custkey"]))
    left = routing.drop_deletes(routing.newest(env, "key", "seq"))
    return left.select(F.col("key").cast("bigint").alias("c_custkey"), "type", F.col("after")["c_mktsegment"].alias("segment"))


@query
def stream_log_only(spark, sf):
    """A change log without the snapshot before it: what was there at the first start is passed over, what came while the job was down is not."""
    stages = Stages(spark, "log-only")
    customers = tb.change_records(spark, sf).filter("topic = 'binlog.shop.customer'")
    for part in ("op = 'READ'", "seq = 2", "seq = 3"):
        parsing.to_json_lines(customers.filter(part)).write.mode("append").text(stages.path("binlog"))
        lines = changes.change_lines(stages.session, stages.path("binlog"), "latest", checkpoint=stages.checkpoint("records"))
        stages.run("records", lines)
    field = lambda path: F.get_json_object("value", path)
    return stages.table("records").select(
        field("$.op").alias("op"), F.coalesce(field("$.after.c_custkey"), field("$.before.c_custkey")).cast("bigint").alias("c_custkey"))


@query
def stream_restart(spark, sf):
    """A chain of two jobs that is stopped, meets a failure between two sinks and goes on with files that came: every record once in each sink."""
    stages = Stages(spark, "restart")
    log = parsing.to_json_lines(tb.app_log(spark, sf).withColumn("_half", F.col("event_id") % 2))
    first = F.get_json_object("value", "$._half") == "0"
    raw, root, kind = stages.path("raw"), stages.path("sinks"), "value string"
    started = F.get_json_object("value", "$.start").isNotNull()
    failures = []

    def starts(batch: DataFrame) -> DataFrame:
        if not failures:  # the first batch dies when its page records are written
            failures.append(1)
            raise RuntimeError("between two sinks")
        return batch.filter(started)

    def job(name: str, stream: DataFrame, sinks: dict) -> None:
        keep_running(lambda: ledger.to_sinks(stream, sinks, root, stages.checkpoint(name), once=True), pause_seconds=0)

    for rows in (log.filter(first), log.filter(~first)):
        rows.select("value").write.mode("append").text(raw)
        job("ods", topics.file_topic(stages.session, raw), {"ods_log": lambda batch: batch.select("value")})
        job("split", ledger.stream_sink(stages.session, root, "ods_log", kind), {"page": lambda batch: batch.filter(~started), "start": starts})
    names = ["ods_log", "page", "start"]
    listed = ledger.read_ledger(spark, root, names).groupBy("sink").agg(F.sum("records").alias("listed"))
    held = [ledger.read_sink(spark, root, n, kind).select(F.lit(n).alias("sink"), F.get_json_object("value", "$.event_id").cast("bigint").alias("id")) for n in names]
    counted = reduce(DataFrame.unionByName, held).groupBy("sink").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("id").alias("different"), F.sum("id").alias("ids"))
    return counted.join(listed, "sink")


@query
def stream_enrich(spark, sf):
    """Orders joined, batch by batch, with dimension tables loaded anew for each batch."""
    stages = Stages(spark, "enrich")
    s = stages.session
    users = stages.path("dims/user")
    dim_sink.create_dim(s, users, "id,birthday,gender")
    rows = tb.dim_user(spark, sf).select("id", "birthday", "gender", F.lit(1).alias("seq"))
    dim_sink.append_changes(rows, users, 0, "id", "seq")
    refresh.enrich(tb.order_info_stream(s, sf), lambda: dim_sink.read_dim(s, users, "id"),
                   lambda batch, dim: wide.with_user(batch, dim, tb.AS_OF), stages.path("orders"), stages.checkpoint("orders"),
                   once=True).awaitTermination()
    return spark.read.parquet(stages.path("orders")).select(F.col("id").alias("order_id"), "user_id", "user_gender", "user_age")


def _version_cuts(spark) -> list:
    return [spark.sql(f"select timestamp '{tb.VERSION_CUT}'").first()[0]]


@query
def stream_enrich_as_of(spark, sf):
    """Orders of two batches with their users as they were when the order was made; users change between and within them."""
    stages = Stages(spark, "enrich-as-of")
    s = stages.session
    users, schema = stages.path("dims/user"), tb.user_versions(spark, sf, False).schema
    replay = Replay(stages, 2)
    orders = replay.add("orders", tb.order_info(spark, sf), "create_at", _version_cuts(spark))
    while replay.feed():
        history.append_versions(tb.user_versions(spark, sf, replay.fed == 2), users, replay.fed)
        refresh.enrich(orders, lambda: history.read_versions(s, users, schema), lambda batch, known: wide.with_user_as_of(batch, known, tb.AS_OF),
                       stages.path("enriched"), stages.checkpoint("enriched"), once=True).awaitTermination()
    return spark.read.parquet(stages.path("enriched")).select(F.col("id").alias("order_id"), "user_id", "user_gender", "user_age")


@query
def order_user_as_of(spark, sf):
    """The same as one batch plan over all versions."""
    known = tb.user_versions(spark, sf, False).unionByName(tb.user_versions(spark, sf, True))
    return wide.with_user_as_of(tb.order_info(spark, sf), known, tb.AS_OF).select(F.col("id").alias("order_id"), "user_id", "user_gender", "user_age")


@query
def stream_config_as_of(spark, sf):
    """Changes of two batches routed by the config of their time; rules change between and within them."""
    stages = Stages(spark, "config-as-of")
    s = stages.session
    replay = Replay(stages, 2)
    early, late = (tb.config_versions(spark, after) for after in (False, True))
    records = replay.add("changes", tb.order_changes(spark, sf), "made_at", _version_cuts(spark))
    env = parsing.change_envelope(records)
    rules = stages.path("rules")
    stages.make_folder(stages.path("in/rules"))
    while replay.feed():
        # Changes of the config come on a stream of their own.
        (early if replay.fed == 1 else late).write.mode("append").parquet(stages.path("in/rules"))
        history.stream_versions(s.readStream.schema(early.schema).parquet(stages.path("in/rules")), rules, stages.checkpoint("rules"),
                                once=True).awaitTermination()
        refresh.db_split(env, lambda: history.read_versions(s, rules, early.schema), stages.path("facts"), stages.path("dims"),
                         stages.checkpoint("split"), "seq", as_of="made_at", once=True).awaitTermination()
    lines = spark.read.schema("value string, batch int, sink_table string").text(stages.path("facts"))
    facts = lines.select("sink_table", F.from_json("value", "map<string,string>").alias("r"))
    kept = dim_sink.read_dim(spark, f"{stages.path('dims')}/dim_orders", "o_orderkey")
    row = F.create_map(F.lit("o_orderkey"), F.col("o_orderkey"), F.lit("o_orderdate"), F.col("o_orderdate"))
    return facts.unionByName(kept.select(F.lit("dim_orders").alias("sink_table"), row.alias("r"))).select(
        "sink_table", F.size("r").alias("n_columns"), F.col("r")["o_orderkey"].cast("bigint").alias("o_orderkey"),
        F.col("r")["o_custkey"].cast("bigint").alias("o_custkey"), F.col("r")["o_totalprice"].cast("double").alias("o_totalprice"),
        F.col("r")["o_orderdate"].alias("o_orderdate"))


@query
def dim_lookup(spark, sf):
    """One dimension row by its key."""
    return lookup(tb.dim_user(spark, sf), "id", 7)


@query
def stream_late_data(spark, sf):
    """Records behind the watermark are left out: the first events, sent again after a far later record."""
    stages = Stages(spark, "late")
    log = tb.app_log(spark, sf)
    once = logs.page_log(log).select("page", "ts", "event_id")
    again = once.filter("event_id < 50")
    schema = once.schema
    for n, rows in enumerate((once, logs.page_log(tb.log_end(spark, sf)).select("page", "ts", "event_id"), again)):
        # All files of a folder are new to one run, so they make one batch.
        rows.write.parquet(stages.path(f"in/{n}"))
        stream = stages.session.readStream.schema(schema).parquet(stages.path("in/*"))
        timed = stream.withColumn("rt", tf.event_time("ts")).withWatermark("rt", "2 seconds")
        counts = timed.groupBy(F.window("rt", DAY_WINDOW)).agg(F.count(F.lit(1)).alias("records"))
        stages.run("counts", counts.select(tf.stamp("window.start").alias("stt"), "records"))
    return stages.table("counts")
