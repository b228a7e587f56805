"""Hand-made rows for the edges the tables do not reach."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillmart import codes, schemas
from rillmart.functions import text, timefns as tf
from rillmart.operators import joins, logs, parsing, reports, routing, stats, upsert, visits, wide
from rillmart.sources import changes, tables

T0 = 1_700_000_000_000


def ids(df, column="event_id"):
    return sorted(r[0] for r in df.select(column).collect())


# --- interval join ------------------------------------------------------------

def pairs(spark, left, right, lower, upper):
    base = datetime(2024, 1, 1, 10)
    l = spark.createDataFrame([(k, i, base + timedelta(milliseconds=m)) for i, (k, m) in enumerate(left)],
                              "k long, l long, lt timestamp")
    r = spark.createDataFrame([(k, i, base + timedelta(milliseconds=m)) for i, (k, m) in enumerate(right)],
                              "rk long, r long, rt timestamp")
    out = joins.interval_join(l, r, "k", "rk", "lt", "rt", lower, upper)
    return sorted((x.l, x.r) for x in out.select("l", "r").collect())


def test_interval_join_bounds_are_inclusive(spark):
    right = [(1, -5000), (1, 5000), (1, -5001), (1, 5001), (1, 0), (2, 0)]
    assert pairs(spark, [(1, 0)], right, timedelta(seconds=-5), timedelta(seconds=5)) == [(0, 0), (0, 1), (0, 4)]


def test_interval_join_uneven_bounds(spark):
    quarter = 15 * 60 * 1000
    right = [(1, -quarter), (1, 5000), (1, -quarter - 1), (1, 5001)]
    assert pairs(spark, [(1, 0)], right, timedelta(minutes=-15), timedelta(seconds=5)) == [(0, 0), (0, 1)]


def test_interval_join_equals_brute_force_on_a_hot_key(spark):
    left = [(1 if i % 3 else i, (i * 7919) % 400_000) for i in range(300)]
    right = [(1 if i % 3 else i, (i * 104729) % 400_000) for i in range(300)]
    want = sorted((i, j) for i, (k, a) in enumerate(left) for j, (m, b) in enumerate(right)
                  if k == m and -15_000 <= b - a <= 5_000)
    assert want and pairs(spark, left, right, timedelta(seconds=-15), timedelta(seconds=5)) == want


def test_interval_join_of_equal_bounds(spark):
    assert pairs(spark, [(1, 0)], [(1, 0), (1, 1)], timedelta(0), timedelta(0)) == [(0, 0)]


# --- bounces --------------------------------------------------------------------

def fates(log, **kw):
    return {r.event_id: r.fate for r in visits.entry_fates(log, **kw).collect()}


def test_fates_at_the_bound(make_log):
    log = make_log([
        ("a", T0, None), ("a", T0 + 9_999, None),
        ("b", T0, None), ("b", T0 + 10_000, None),
        ("c", T0, None), ("c", T0 + 9_999, "x"),
        ("d", T0, None), ("d", T0 + 10_000, "x"),
        ("e", T0, None), ("e", T0 + 3_000, None), ("e", T0 + 6_000, None),
        ("f", T0, None), ("f", T0, None),
        ("g", T0, "x"), ("g", T0 + 1, "y"),
    ])
    assert fates(log) == {0: "matched", 1: "timeout", 2: "timeout", 3: "timeout", 4: "killed", 6: "timeout",
                          8: "matched", 9: "matched", 10: "timeout", 11: "matched", 12: "timeout"}
    assert ids(visits.user_jump(log)) == [0, 1, 2, 3, 6, 8, 9, 10, 11, 12]


def brute_fates(rows, bound):
    out = {}
    by_mid = {}
    for i, (mid, ts, last) in enumerate(rows):
        by_mid.setdefault(mid, []).append((ts, i, last))
    for items in by_mid.values():
        items.sort()
        for n, (ts, i, last) in enumerate(items):
            if last is None:
                after = items[n + 1] if n + 1 < len(items) else None
                if after is None or after[0] >= ts + bound:
                    out[i] = "timeout"
                else:
                    out[i] = "matched" if after[2] is None else "killed"
    return out


@pytest.mark.parametrize("span", [1, 2, 30])
def test_fates_equal_brute_force_across_slices(make_log, span):
    rows = [("hot" if i % 3 else f"m{i % 7}", T0 + (i * 7919) % 900_000, None if (i * 31) % 5 else "x")
            for i in range(400)]
    assert fates(make_log(rows), span=span) == brute_fates(rows, 10_000)


# --- flags and visits --------------------------------------------------------------

def flags(log):
    return {r.event_id: r.is_new for r in logs.repair_new_flag(log).select("event_id", "common.is_new").collect()}


def test_only_the_first_claim_keeps_the_flag(make_log):
    rows = [("a", 1, None, "1"), ("a", 2, None, "1"), ("a", 3, None, "1"),
            ("b", 1, None, "0"), ("b", 2, None, "1"), ("b", 3, None, "1"),
            ("c", 5, None, "1"), ("c", 5, None, "1"), ("d", 1, None, None)]
    want = {0: "1", 1: "0", 2: "0", 3: "0", 4: "1", 5: "0", 6: "1", 7: "0", 8: None}
    log = make_log(rows)
    assert flags(log) == want
    whole = logs.repair_new_flag(log, split=False).select("event_id", "common.is_new").collect()
    assert {r.event_id: r.is_new for r in whole} == want


def test_unique_visit_per_day(make_log):
    day = 86_400_000
    start = 20_000 * day
    log = make_log([("a", start + 5, None), ("a", start + 9, None), ("a", start + day, None),
                    ("a", start + 1, "x"), ("b", start + day - 1, None), ("b", start + day + 1, "x")])
    assert ids(visits.unique_visit(log)) == [0, 2, 4]


def test_displays(spark, make_log):
    log = make_log([("a", 1, None)]).drop("displays").crossJoin(spark.createDataFrame(
        [(None,), ([],), ([("1", "sku_id"), ("2", "activity_id"), ("3", "sku_id")],)],
        "displays array<struct<item:string,item_type:string>>"))
    assert logs.display_log(log).count() == 3
    topics = {r.sink_table: r.n for r in logs.routed_log(log).groupBy("sink_table").agg(F.count("*").alias("n")).collect()}
    assert topics == {"dwd_page_log": 3, "dwd_display_log": 3}


# --- parsing ----------------------------------------------------------------------------

def test_dirty_lines(spark):
    good = ['{"common":{"mid":"1"},"ts":5}', '{"common":{"mid":"2"},"displays":[],"ts":6}',
            '{"common":{"mid":"3"},"displays":[{"item":"1"},{},{"item":"3"}],"ts":7}']
    bad = ['{"common":{"mid":"1"},"ts', "", "   ", '"text"', "17", "[1,2]", '[{"common":{"mid":"9"}}]', "null",
           '{"ts":5}', '{"common":null,"ts":5}', "not json"]
    lines = spark.createDataFrame([(v,) for v in good + bad], "value string")
    records, dirty = parsing.parse_lines(lines, schemas.PAGE_LOG, ("common.mid",))
    assert sorted(r.common.mid for r in records.collect()) == ["1", "2", "3"]
    assert sorted(r.value for r in dirty.collect()) == sorted(bad)


def test_json_lines_leave_nulls_out(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert parsing.to_json_lines(df).first().value == '{"a":1}'


def test_envelopes(spark):
    records = spark.createDataFrame(
        [("s.shop.t", "READ", None, {"a": "1"}), ("s.shop.t", "CREATE", None, {"a": "2"}),
         ("s.shop.t", "UPDATE", {"a": "2"}, {"a": "3"}), ("s.shop.t", "DELETE", {"a": "3"}, None)],
        "topic string, op string, before map<string,string>, after map<string,string>")
    env = parsing.change_envelope(records).collect()
    assert [r.type for r in env] == ["insert", "insert", "update", "delete"]
    assert env[0].before == {} and env[3].after == {} and env[0].tableName == "t"
    flat = parsing.flat_envelope(records).collect()
    assert [r.operation for r in flat] == ["read", "create", "update"]


def test_snapshot_records(spark):
    t = spark.createDataFrame([(1, None)], "id int, name string")
    row = parsing.change_envelope(changes.snapshot_records(t, "shop", "user")).first()
    assert (row.database, row.tableName, row.type, row.after) == ("shop", "user", "insert", {"id": "1"})


# --- routing and upsert -------------------------------------------------------------------

CHANGE = "database string, tableName string, before map<string,string>, after map<string,string>, type string"


def test_routing(spark):
    rows = [("shop", "user", {}, {"id": "1", "name": "n", "secret": "s"}, "insert"),
            ("shop", "user", {}, {}, "delete"), ("shop", "user", {}, {"id": "2"}, None),
            ("shop", "other", {}, {"id": "3"}, "insert"), ("shop", "orders", {}, {"id": "4", "x": "1"}, "insert"),
            ("shop", "stat", {}, {"id": "5"}, "insert")]
    config = spark.createDataFrame(
        [("user", "insert", "hbase", "dim_user", "id,name", "id", None),
         ("user", "delete", "hbase", "dim_user", "id,name", "id", None),
         ("orders", "insert", "kafka", "dwd_orders", "id, x", None, None),
         ("stat", "insert", "clickhouse", "s", "id", None, None)], schemas.ROUTING)
    changes_df = spark.createDataFrame(rows, CHANGE)
    assert routing.drop_deletes(changes_df).count() == 5
    routed = routing.route_changes(changes_df, config)
    assert [r.after for r in routing.dim_changes(routed).collect()] == [{"id": "1", "name": "n"}]
    # names are matched as they stand, so " x" with its blank keeps nothing
    assert [r.after for r in routing.fact_changes(routed).collect()] == [{"id": "4"}]
    assert routed.count() == 3


def test_current_routing(spark):
    log = spark.createDataFrame(
        [("user", "insert", "hbase", "old", "id", None, None, "insert", 1),
         ("user", "insert", "hbase", "new", "id", None, None, "update", 2),
         ("gone", "insert", "hbase", "x", "id", None, None, "insert", 1),
         ("gone", "insert", "hbase", "x", "id", None, None, "delete", 2)],
        "sourceTable string, operateType string, sinkType string, sinkTable string, sinkColumns string, "
        "sinkPk string, sinkExtend string, type string, seq int")
    assert [r.sinkTable for r in routing.current_routing(log, "seq").collect()] == ["new"]


def test_upsert(spark):
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    new = spark.createDataFrame([("2", "x", 1), ("2", "y", 2), ("3", "z", 1)], "id string, v string, seq int")
    assert sorted(map(tuple, upsert.upsert(base, new, "id", "seq").collect())) == [("1", "a"), ("2", "y"), ("3", "z")]


# --- dimensions and wide records --------------------------------------------------------------

def test_dim_join_of_unknown_keys(spark):
    facts = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k long, name string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    assert [tuple(r) for r in joins.dim_join(facts, dim, "k", {"name": "name"}).collect()] == [(1, "one")]
    left = joins.dim_join(facts, dim, "k", {"name": "name"}, how="left")
    assert sorted((r.k or 0, r.name) for r in left.collect()) == [(0, None), (1, "one"), (2, None)]


def test_lookup(spark):
    dim = spark.createDataFrame([("1", "one"), ("2", "two")], "id string, name string")
    assert tables.lookup(dim, "id", 2).first().name == "two"


def order_rows(spark):
    orders = spark.createDataFrame(
        [(1, 7, "1001", 5, 10, "2024-01-01 10:00:00")],
        "id long, province_id long, order_status string, user_id long, total_amount int, create_time string")
    for c in ("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee", "total_amount"):
        orders = orders.withColumn(c, F.lit(10).cast("decimal(16,2)"))
    details = spark.createDataFrame(
        [(11, 1, 3, "2024-01-01 10:00:05"), (12, 1, 3, "2024-01-01 09:59:55"), (13, 1, 3, "2024-01-01 10:00:06"),
         (14, 1, 3, "no time")], "id long, order_id long, sku_id long, create_time string")
    for c in ("order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount"):
        details = details.withColumn(c, F.lit(5).cast("decimal(16,2)"))
    return orders, details.withColumn("sku_num", F.lit(1).cast("bigint")).withColumn("sku_name", F.lit("raw"))


def dims(spark):
    return wide.Dims(
        spark.createDataFrame([("5", "2000-01-01", "F")], "id string, birthday string, gender string"),
        spark.createDataFrame([("7", "P", "a", "i", "i2")],
                              "id string, name string, area_code string, iso_code string, iso_3166_2 string"),
        spark.createDataFrame([("3", "sku", "9.50", "c", "s", "t")],
                              "id string, sku_name string, price string, category3_id string, spu_id string, tm_id string"
                              ).withColumn("category3_id", F.lit("30")).withColumn("spu_id", F.lit("31")).withColumn(
            "tm_id", F.lit("32")),
        spark.createDataFrame([("31", "spu")], "id string, spu_name string"),
        spark.createDataFrame([("32", "tm")], "id string, tm_name string"),
        spark.createDataFrame([("30", "cat")], "id string, name string"))


def test_order_and_payment_wide(spark):
    orders, details = order_rows(spark)
    w = wide.order_wide(orders, details, dims(spark), "2024-01-01 00:00:00")
    rows = {r.detail_id: r for r in w.collect()}
    assert sorted(rows) == [11, 12]
    r = rows[11]
    assert (r.user_age, r.user_gender, r.sku_name, r.tm_name, r.category3_name, r.spu_id) == (24, "F", "sku", "tm", "cat", 31)
    assert (r.create_date, r.create_hour, r.expire_time, r.split_feight_fee) == ("2024-01-01", "10", None, None)
    pay = spark.createDataFrame(
        [(1, 1, 99, 77, "s", "1101", "2024-01-01 10:15:00", None), (2, 1, 99, 77, "s", "1101", "2024-01-01 10:15:01", None),
         (3, 1, 99, 77, "s", "1101", "2024-01-01 09:59:55", None), (4, 1, 99, 77, "s", "1101", "2024-01-01 09:59:54", None)],
        "id long, order_id long, user_id long, total_amount int, subject string, payment_type string, "
        "create_time string, callback_time string")
    paid = wide.payment_wide(pay, w).collect()
    assert sorted((p.payment_id, p.detail_id) for p in paid) == [(1, 11), (1, 12), (3, 11), (3, 12)]
    assert {(p.user_id, p.total_amount, p.order_create_time) for p in paid} == {(99, 77, "2024-01-01 10:00:00")}


def test_order_wide_fields(spark):
    orders, details = order_rows(spark)
    w = wide.order_wide(orders, details, dims(spark), "2024-01-01 00:00:00")
    assert len(w.drop("create_at").columns) == 35


def test_unknown_dimension_drops_or_keeps(spark):
    orders, details = order_rows(spark)
    d = dims(spark)
    d.province = d.province.limit(0)
    assert wide.order_wide(orders, details, d, "2024-01-01 00:00:00").count() == 0
    assert wide.order_wide(orders, details, d, "2024-01-01 00:00:00", how="left").count() == 2


def test_merge_fills_but_not_the_split_amounts(spark):
    a = spark.createDataFrame([(1, None, None), (2, "B", None)], "detail_id long, sku_name string, split_total_amount int")
    b = spark.createDataFrame([(1, "A", 5), (2, "X", 6)], "detail_id long, sku_name string, split_total_amount int")
    got = sorted(map(tuple, wide.merge_order_wide(a, b).collect()))
    assert got == [(1, "A", None), (2, "B", None)]


# --- statistics and reports ----------------------------------------------------------------------

def test_distinct_orders_are_exact(spark):
    orders = spark.createDataFrame(
        [(1, 1, 2, "5.10", "2024-01-01 00:00:01"), (1, 1, 1, "0.20", "2024-01-01 00:00:02"),
         (2, 1, 1, "1.00", "2024-01-01 00:00:09"), (1, 1, 1, "1.00", "2024-01-01 00:00:10")],
        "order_id long, sku_id long, sku_num long, split_total_amount string, create_time string")
    comments = spark.createDataFrame([(1, "1201", "2024-01-01 00:00:03"), (1, "1203", "2024-01-01 00:00:03")],
                                     "sku_id long, appraise string, create_time string")
    got = sorted(stats.product_stats(stats.product_rows(orders=orders, comments=comments)).collect(), key=lambda r: r.stt)
    assert [(r.stt, r.edt, r.order_ct, r.order_sku_num, str(r.order_amount), r.comment_ct, r.good_comment_ct)
            for r in got] == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", 2, 4, "6.30", 2, 1),
                              ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 1, 1, "1.00", 0, 0)]
    assert got[0].paid_order_ct == 0 and got[0].refund_order_ct == 0


def test_province_rows_have_the_table_columns(spark):
    orders, details = order_rows(spark)
    w = wide.order_wide(orders, details, dims(spark), "2024-01-01 00:00:00")
    assert stats.province_rows(w).columns == schemas.PROVINCE_STATS
    row = stats.province_stats(w, "1 hour").first()
    assert (row.order_count, str(row.order_amount), row.stt) == (1, "10.00", "2024-01-01 10:00:00")


@pytest.mark.parametrize("uv,sv,uj,dur,pv,want", [
    (0, 5, 1, 10, 5, (0.0, 0.0, 0.0)),
    (3, 0, 1, 10, 5, (0.0, 0.0, 0.0)),
    (1, 1000, 5, 1_049_500, 1, (0.5, 1.1, 0.0)),
    (1, 3, 2, 100_000, 8, (66.67, 33.3, 2.67)),
    (1, 8, 1, 10, 1, (12.5, 0.0, 0.13)),
])
def test_ratios(spark, uv, sv, uj, dur, pv, want):
    df = spark.createDataFrame([(uv, sv, uj, dur, pv)], "uv_ct long, sv_ct long, uj_ct long, dur_sum long, pv_ct long")
    r = reports.with_ratios(df).first()
    assert (r.uj_rate, r.dur_per_sv, r.pv_per_sv) == want


def test_keyword_score_ranks_by_raw_count(spark):
    rows = [("a", 5, "click"), ("b", 3, "SEARCH"), ("c", 9, "nothing")]
    df = spark.createDataFrame([(k, c, s, "2024-01-05 00:00:00") for k, c, s in rows],
                               "keyword string, ct long, source string, stt string")
    got = [tuple(r) for r in reports.keyword_scores(df, 20240105, 2).collect()]
    assert got == [("c", 0), ("a", 5)]
    assert reports.keyword_scores(df, 20240106).count() == 0


def test_gmv_of_an_empty_day(spark):
    df = spark.createDataFrame([("2024-01-05 00:00:00", 1)], "stt string, order_amount int")
    assert reports.gmv(df, 20240106).collect()[0].gmv is None
    assert reports.gmv(df, 20240105).collect()[0].gmv == 1.0


def test_series(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0)], "n string, v double")
    row = reports.series(df, "n", "v").first()
    assert (row.categories, row.series) == (["b", "c", "a"], [3.0, 3.0, 1.0])


def test_new_against_old_sums_the_old_side(spark):
    rows = [("1", 2, 4, 2, 1, 4000), ("0", 1, 2, 1, 0, 1000), (None, 1, 2, 1, 1, 1000)]
    df = spark.createDataFrame(rows, "is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long")
    got = {r.type: (r.new, r.old) for r in reports.new_against_old(df).collect()}
    assert got == {"visitors": (2.0, 2.0), "pages": (4.0, 4.0), "bounce_rate": (50.0, 50.0),
                   "seconds_per_visit": (2.0, 1.0), "pages_per_visit": (2.0, 2.0)}


# --- text and time ---------------------------------------------------------------------------------

def test_words(spark):
    df = spark.createDataFrame([(1, "Apple手机 X10, apple"), (2, "!!"), (3, None)], "i int, t string")
    got = [(r.i, r.word) for r in text.explode_words(df, "t").collect()]
    assert got == [(1, "apple"), (1, "手"), (1, "机"), (1, "x10"), (1, "apple")]
    pairs_of = text.explode_words(df, "t", han_pairs=True).collect()
    assert "手机" in {r.word for r in pairs_of}
    stop = spark.createDataFrame([("apple",)], "word string")
    assert {r.word for r in text.explode_words(df, "t", stop_words=stop).collect()} == {"手", "机", "x10"}


def test_own_tokenizer(spark):
    def halves(value):
        left, right = value.split("-")
        return [left, right]

    df = spark.createDataFrame([("a-b",), ("whole",), (None,)], "t string")
    assert [r.word for r in text.explode_words(df, "t", tokenizer=halves).collect()] == ["a", "b", "whole"]


def test_names():
    assert text.snake_to_camel("ORDER_ID") == "orderId" and text.snake_to_camel("a_b1_c") == "aB1C"


def test_camel_columns(spark):
    assert text.camel_columns(spark.createDataFrame([(1, 2)], "sku_id int, tm_name int")).columns == ["skuId", "tmName"]


@pytest.mark.parametrize("value,ok", [("2024-01-31 10:20:30", True), ("2024-01-31", False), ("2024-13-31 10:20:30", False),
                                      ("2024-01-31T10:20:30", False), ("", False), (None, False),
                                      ("2024-01-31 10:20:3x", False)])
def test_parse_stamp(spark, value, ok):
    df = spark.createDataFrame([(value,)], "t string").select(tf.parse_stamp("t").alias("p"), tf.stamp(tf.parse_stamp("t")))
    row = df.first()
    assert (row[0] is not None) == ok
    assert row[1] == (value if ok else None)


def test_age_has_no_leap_days(spark):
    df = spark.createDataFrame([("2000-01-01",), ("x",)], "b string")
    ages = [r[0] for r in df.select(tf.age_years("b", "2019-12-27 00:00:00")).collect()]
    assert ages == [20, None]


def test_unreadable_time_takes_arrival(spark):
    df = spark.createDataFrame([("bad", datetime(2024, 1, 1))], "t string, a timestamp")
    assert df.select(tf.stamp_or("t", "a")).first()[0] == datetime(2024, 1, 1)


def test_codes(spark):
    table = codes.code_table(spark)
    assert table.count() == sum(len(v) for v in codes.CODES.values())
    df = spark.createDataFrame([("1101",), ("9",)], "c string").select(codes.decode("payment_type", "c").alias("n"))
    assert [r.n for r in df.collect()] == ["ALIPAY", None]


# --- open records ------------------------------------------------------------------

def test_loose_numbers_are_read(spark):
    lines = spark.createDataFrame([
        (1, '{"common":{"mid":"a"},"page":{"during_time":"120"},"ts":"1704067200000"}'), (2, '{"common":{"mid":"a"},"page":{"during_time":12.5},"ts":1}'),
        (3, '{"common":{"mid":"a"},"ts":"soon"}'), (4, "[]"), (5, ""), (6, None), (7, '{"common":{"mid":7},"page":{"during_time":"x"},"ts":2.9e3}'),
    ], "n int, value string")
    got = {r.n: (r.dirty, r.page and r.page.during_time, r.ts) for r in parsing.parse_marked(lines, schemas.PAGE_LOG, ("common.mid", "ts")).collect()}
    assert got[1] == (False, 120, 1704067200000) and got[2] == (False, 12, 1) and got[7] == (False, None, 2900)
    assert all(got[n][0] for n in (3, 4, 5, 6))


def test_records_are_handed_on_whole(spark):
    line = ('{"common":{"mid":"a","is_new":"1","md":"x","uid":5},"page":{"page_id":"p\\"q","source_type":"ad"},"displays":[{"item":"1","pos_id":2},{"order":[1,2.5]}],'
            '"actions":[{"id":1}],"err":{"code":3},"ts":1}')
    start = '{"common":{"mid":"a","is_new":"1"},"start":{"entry":"icon"},"ts":2,"extra":null}'
    log, _ = parsing.parse_lines(spark.createDataFrame([(line,), (start,)], "value string"), schemas.PAGE_LOG, ("common.mid", "ts"), keep=True)
    out = logs.routed_whole(logs.repair_new_flag(log, order_by=("ts",))).collect()
    by = {}
    for r in out:
        by.setdefault(r.sink_table, []).append(json.loads(r.value))
    assert by["dwd_page_log"] == [json.loads(line)]
    assert by["dwd_display_log"] == [{"item": "1", "pos_id": 2, "page_id": 'p"q'}, {"order": [1, 2.5], "page_id": 'p"q'}]
    want = json.loads(start)
    want["common"]["is_new"] = "0"
    assert by["dwd_start_log"] == [want]


def test_one_exchange_for_bounces(spark, make_log):
    plan = visits.user_jump(make_log([("a", 1, None), ("a", 2, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_words_of_other_scripts(spark):
    row = spark.createDataFrame([("Caf\u00e9 K\u00f6ln \u0422\u041e\u0412\u0410\u0420 \u30ab\u30e1\u30e9 \ud734\ub300\ud3f0 \u624b\u673a x2",)], "t string").select(text.words("t").alias("w")).first()
    assert row.w == ["caf\u00e9", "k\u00f6ln", "\u0442\u043e\u0432\u0430\u0440", "\u30ab\u30e1\u30e9", "\ud734\ub300\ud3f0", "\u624b", "\u673a", "x2"]


def test_no_weights_score_nothing(spark):
    kw = spark.createDataFrame([("a", 3, "search", "2024-01-01 00:00:00")], "keyword string, ct long, source string, stt string")
    assert [tuple(r) for r in reports.keyword_scores(kw, 20240101, weights={}).collect()] == [("a", 0)]
