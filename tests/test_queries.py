"""Every registered query against its SQL counterpart."""

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, compare
from rillmart.plans.catalog import QUERIES
from rillmart.plans.oracle import ORACLES

from .conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    note, _, ok = compare(name, spark, con, SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dated_reports_read_one_day_of_a_stored_table(spark):
    for name in ("report_gmv", "report_brand", "report_brand_all", "report_category3", "report_spu", "report_province", "report_visitor_new_old",
                 "report_visitor_hour", "report_keyword", "report_gmv_today"):
        plan = _plan(QUERIES[name](spark, SF_DIR))
        assert "PartitionFilters: [isnotnull(dt" in plan and "events.parquet" not in plan and "lineitem" not in plan, name


def test_product_statistics_join_orders_and_details_once(spark):
    QUERIES["payment_wide"](spark, SF_DIR)  # writes the wide orders
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["product_stats_wide"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") <= 23 and "dwm_order_wide" in plan


def test_kept_tables_follow_their_inputs(spark, tmp_path):
    from rillmart.sinks.kept import kept_table

    folder = str(tmp_path / "in")
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    read = lambda: kept_table(spark, folder, "doubled", ("t",), lambda: spark.read.parquet(f"{folder}/t.parquet").selectExpr("id * 2 as id"))
    assert sorted(r.id for r in read().collect()) == [0, 2, 4]
    spark.range(3).write.mode("append").parquet(f"{folder}/t.parquet")
    assert sorted(r.id for r in read().collect()) == [0, 0, 2, 2, 4, 4]


def test_the_callers_zone_is_left_alone(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    rows = QUERIES["user_age"](other, SF_DIR)
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert rows.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC" and rows.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"


def test_any_part_types_are_numbered(spark, tmp_path):
    from rillmart.sources import testbed as tb

    spark.createDataFrame([(1, "n", "b1", "NEW KIND", 3, 1.0), (2, "m", "b2", "OTHER", 3, 2.0), (3, "o", "b2", None, 3, 2.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    ids = {r.id: r.category3_id for r in tb.dim_sku(spark, str(tmp_path)).collect()}
    assert len(ids) == 3 and ids["1"] != ids["2"] and ids["3"] is None


def test_events_name_as_many_skus_as_there_are_parts(spark, tmp_path):
    from rillmart.sources import testbed as tb

    spark.range(4000).selectExpr("id as p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(9000).selectExpr("id as event_id", "1L as user_id", "case id % 2 when 0 then 'view' else 'click' end as event_type", "1.0D as value",
                                 "'{\"k\": 1}' as props", "timestamp'2024-01-01' as ts").write.parquet(f"{tmp_path}/events.parquet")
    log = tb.app_log(spark, str(tmp_path))
    assert {int(r.item) for r in log.select("page.item").dropna().collect()} == set(range(0, 4000, 2))
    assert {int(r.item) for r in log.selectExpr("displays[0].item as item").dropna().collect()} == set(range(4000))
    assert {r.sku_id for r in tb.favor_info(spark, str(tmp_path)).collect()} == set(range(1, 4000, 2))
    spark.createDataFrame([], "p_partkey long").write.mode("overwrite").parquet(f"{tmp_path}/part.parquet")
    assert {r.sku_id for r in tb.favor_info(spark, str(tmp_path)).collect()} == {0}
