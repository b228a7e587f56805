"""Sets of order ids: counts of united sets against counts of the ids."""

import random

import pytest
from pyspark.sql import functions as F

from rillmart.functions.timefns import yyyymmdd
from rillmart.operators.order_sets import distinct_orders, order_sets, unite
from rillmart.operators.stats import ORDER_KINDS
from rillmart.sinks import days

ROWS = "sku_id long, at string, kind string, oid long"
NAMES = {kind: name for name, kind in ORDER_KINDS.items()}


def _rows(spark, rows):
    return spark.createDataFrame(rows, ROWS).withColumn("rt", F.to_timestamp("at"))


def _expected(rows, group):
    found = {}
    for r in rows:
        if r[1] and r[3] is not None:
            found.setdefault(group(r), {k: set() for k in NAMES})[r[2]].add(r[3])
    return {g: tuple(len(ids[k]) for k in NAMES) for g, ids in found.items()}


def _got(df, by):
    return {tuple(r[c] for c in by): tuple(r[NAMES[k]] for k in NAMES) for r in df.collect()}


@pytest.mark.parametrize("most_listed", [0, 3, 1024])
def test_counts_of_united_sets(spark, most_listed):
    r = random.Random(4)
    ids = [0, 1, 32767, 32768, 32769, 65536, 2 ** 40, -5, -32768, *range(100, 140)]
    rows = [(r.choice([1, 2, None]), f"2024-0{r.randrange(1, 4)}-1{r.randrange(4)} 10:00:00", r.choice(list(NAMES)), r.choice(ids)) for _ in range(600)]
    rows += [(1, None, "order", 7), (2, "2024-01-10 00:00:00", "order", None), (2, "2024-01-10 00:00:00", None, None)]
    sets = order_sets(_rows(spark, rows), most_listed=most_listed).withColumn("month", F.substring("stt", 1, 7))
    for c in sets.select(F.size("listed").alias("few"), "bits").collect():
        assert (c.bits is None) != (c.few is None or c.few < 0) and (c.bits is None or len(c.bits) == 4096)
    month = lambda x: x[1][:7]
    assert _got(distinct_orders(sets, ["month", "sku_id"]), ["month", "sku_id"]) == _expected(rows, lambda x: (month(x), x[0]))
    assert _got(distinct_orders(sets, ["month"]), ["month"]) == _expected(rows, lambda x: (month(x),))
    assert _got(distinct_orders(sets, ["sku_id"]), ["sku_id"]) == _expected(rows, lambda x: (x[0],))


def test_a_hot_group_is_a_row_per_bucket(spark):
    orders = spark.range(1, 100_001).select(
        F.lit(1).cast("long").alias("sku_id"), F.lit("order").alias("kind"), F.col("id").alias("oid"), F.to_timestamp(F.lit("2024-01-01 12:00:00")).alias("rt"))
    sets = order_sets(orders.unionByName(orders))
    assert sets.count() == 4 and sets.filter("bits is null").count() == 0
    assert unite(sets, ["sku_id"]).agg(F.sum("n")).first()[0] == 100_000


def test_bitmaps_hold_the_ids(spark):
    r = random.Random(7)
    rows = [(sku, "2024-01-01 10:00:00", "order", r.randrange(40_000)) for sku, n in ((1, 3), (2, 300), (3, 5000)) for _ in range(n)]
    rows += [(4, "2024-01-01 10:00:00", "order", oid) for oid in (0, 7, 8, 56, 63, 64, 32767, 32768)]
    want = {(x.sku_id, x.bucket): bytes(x.bits) for x in _rows(spark, rows).groupBy("sku_id", F.bitmap_bucket_number("oid").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("oid")).alias("bits")).collect()}
    for most_listed in (0, 2, 1024):
        sets = order_sets(_rows(spark, rows), most_listed=most_listed)
        for x in sets.filter("listed is not null").collect():
            assert x.listed == [p for p in range(32768) if want[x.sku_id, x.bucket][p // 8] >> p % 8 & 1]
        assert all(bytes(x.bits) == want[x.sku_id, x.bucket] for x in sets.filter("bits is not null").collect())
        assert {(x.sku_id, x.bucket): bytes(x.bits) for x in unite(sets, ["sku_id"]).collect()} == want


def test_small_sets_are_counted_without_bitmaps(spark):
    """A bitmap takes four kilobytes, whatever it holds: none is made for each group while sets are built or counted."""
    sets = order_sets(_rows(spark, [(1, "2024-01-01 00:00:00", "order", 1)]))
    for df in (sets, distinct_orders(sets, ["sku_id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" not in plan and "bitmap_or_agg" not in plan


def test_no_rows(spark):
    sets = order_sets(_rows(spark, []))
    assert sets.count() == 0 and distinct_orders(sets, ["sku_id"]).count() == 0


def test_bitmaps_cross_no_exchange(spark):
    plan = order_sets(_rows(spark, [(1, "2024-01-01 00:00:00", "order", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    stored = spark.createDataFrame([], "sku_id long, kind string, bucket long, listed array<smallint>, bits binary")
    assert unite(stored, ["sku_id"])._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_sets_of_days_that_arrive(spark, tmp_path):
    """A late file rebuilds the sets of its days alone, and the month's count follows."""
    folder, path = f"{tmp_path}/in", f"{tmp_path}/sets"
    arrived = days.Input("orders", folder, lambda rows: F.array(yyyymmdd("rt")))

    def build(changed):
        return order_sets(spark.read.parquet(folder).filter(days.in_days("rt", changed)))

    def arrive(rows):
        _rows(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        return days.refresh(spark, path, [arrived], build, "1")

    def month():
        return distinct_orders(days.read_days(spark, path).withColumn("month", F.floor(F.col("dt") / 100)), ["month"]).first().order_ct

    first = [(1, "2024-01-01 10:00:00", "order", 1), (2, "2024-01-01 10:00:00", "order", 1), (1, "2024-01-02 10:00:00", "order", 2)]
    assert arrive(first) == [20240101, 20240102] and month() == 2
    assert arrive([(3, "2024-01-02 11:00:00", "order", 1), (3, "2024-01-02 11:00:00", "order", 9)]) == [20240102] and month() == 3
