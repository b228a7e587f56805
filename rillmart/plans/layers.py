"""The layers as whole flows: batch as one lazy plan, streams as a chain of topics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from ..functions.timefns import moment
from ..operators import logs, stats, visits, wide
from ..streaming import stateful
from ..streaming.batched import Side, WindowSums
from ..streaming.jobs import Stages
from ..streaming.merged import MergedSources


def visitor_inputs(log: DataFrame, within: timedelta) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, unique visits, bounces) of an app log, all with repaired flags.

    The repair does not change which records are unique visits or bounces, so it
    comes after they are picked and joins far fewer rows.
    """
    claims = logs.first_claims(log)
    pages = logs.page_log(log)
    return (
        logs.repair_new_flag(pages, claims),
        logs.repair_new_flag(visits.unique_visit(pages), claims, split=False),
        logs.repair_new_flag(visits.user_jump(pages, within), claims, split=False),
    )


def visitor_stats(log: DataFrame, within: timedelta = visits.WITHIN, window: str = stats.WINDOW) -> DataFrame:
    """App log to visitor statistics."""
    return stats.visitor_stats(*visitor_inputs(log, within), window)


def stream_visitor_stats(stages: Stages, log: DataFrame, within: timedelta, window: str,
                         bounce_delay: str = "2 seconds", delay: str = "14 seconds") -> DataFrame:
    """The visitor chain on streams: flag repair, split, unique visits, bounces, statistics."""
    stages.run("dwd_page_log", logs.page_log(stateful.repair_new_flag_stream(log)))
    stages.run("dwm_unique_visit", stateful.unique_visit_stream(stages.stream("dwd_page_log")))
    stages.run("dwm_user_jump", stateful.user_jump_stream(stages.stream("dwd_page_log"), within, bounce_delay))
    stages.run("visitor_stats", stats.visitor_stats(
        stages.stream("dwd_page_log"), stages.stream("dwm_unique_visit"), stages.stream("dwm_user_jump"),
        window, delay))
    return stages.table("visitor_stats")


def stream_wide(stages: Stages, orders: DataFrame, details: DataFrame, payments: DataFrame, dims: wide.Dims, as_of,
                order_bounds: tuple[timedelta, timedelta], pay_bounds: tuple[timedelta, timedelta], pay_delay: str = wide.IN_ORDER) -> None:
    """Orders with details and payments with orders, as topics ``dwm_order_wide`` and ``dwm_payment_wide``.

    Wide orders come when their details do, so over several batches ``pay_delay``
    has to allow for the time an order may wait.
    """
    side = lambda rows, delay: Side(rows, moment(rows, "create_time"), delay)
    product = dims.product()
    stages.run_pairs("dwm_order_wide", side(wide.placed(orders, dims, as_of), wide.IN_ORDER), side(details, wide.IN_ORDER), *order_bounds,
                     lambda o, d: wide.join_order_detail(o, d, *order_bounds), lambda pairs: wide.with_product(pairs, product))
    stages.run_pairs("dwm_payment_wide", side(payments, pay_delay), side(stages.stream("dwm_order_wide"), pay_delay), *pay_bounds,
                     lambda p, w: wide.payment_wide(p, w, *pay_bounds))


#: The seven sources of product statistics and the sums they add to.
PRODUCT_SOURCES = ("pages", "favor", "cart", "orders", "payments", "refunds", "comments")


def product_sources(stages: Stages, window: str, delays: dict[str, str], **sources: DataFrame) -> MergedSources:
    """Product statistics with a watermark for each source; ``delays`` says how far each is out of order."""
    sums = WindowSums(lambda rows, *also: stats.order_sums(rows, window, *also), stats.order_sums_again, stats.sums_of_orders)
    merged = MergedSources(stages, "product_stats", sums, stats.merge_product_stats)
    for name in PRODUCT_SOURCES:
        if name in sources:
            merged.add(name, stats.product_rows(**{name: sources[name]}), delays.get(name, "2 seconds"))
    return merged


def dims_from(spark: SparkSession, sf_dir: str) -> wide.Dims:
    from ..sources import testbed as tb

    return wide.Dims(*[f(spark, sf_dir) for f in (
        tb.dim_user, tb.dim_province, tb.dim_sku, tb.dim_spu, tb.dim_brand, tb.dim_category3)])
