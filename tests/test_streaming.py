"""Streams against the batch functions: several batches, restarts, disorder, late records."""

import os

import pytest
from pyspark.sql import functions as F

from rillmart.operators import logs, stats, visits, wide
from rillmart.plans import layers
from rillmart.sinks.topics import start
from rillmart.sources import testbed as tb
from rillmart import schemas
from rillmart.operators import joins, parsing
from rillmart.sinks import dims
from rillmart.sources.topics import file_topic
from rillmart.streaming import refresh, stateful
from rillmart.streaming.jobs import Stages

from .conftest import SF_DIR

T0 = 1_700_000_000_000
FAR = T0 + 10**12


class Feed:
    """A folder fed with one Parquet file per batch of rows, read one file per batch."""

    def __init__(self, spark, make_log, path):
        self.spark, self.make_log, self.path, self.n = spark, make_log, str(path), 0
        self.schema = make_log([("x", 1, None)]).schema
        os.makedirs(self.path, exist_ok=True)

    def add(self, log):
        self.n += 1
        part = f"{self.path}-parts/{self.n}"
        log.coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{self.path}/{self.n:04d}.parquet"
        os.link(f"{part}/{name}", target)
        os.utime(target, (1_700_000_000 + self.n, 1_700_000_000 + self.n))

    def rows(self, *rows):
        self.add(self.make_log(list(rows)).withColumn("event_id", F.col("event_id") + 1000 * self.n))

    def stream(self, session):
        return session.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def table(self):
        return self.spark.read.schema(self.schema).parquet(self.path)


@pytest.fixture
def feed(spark, make_log, tmp_path):
    return Feed(spark, make_log, tmp_path / "in")


@pytest.fixture
def stages(spark, tmp_path):
    return Stages(spark, "test", folder=str(tmp_path / "out"), state_partitions=2)


def rows_of(df):
    return sorted(map(str, (r.asDict(recursive=True) for r in df.collect())))


def fill(spark, feed, parts=3):
    """The event log cut into files by time, then one record far in the future."""
    log = tb.app_log(spark, SF_DIR).drop("displays").withColumn(
        "displays", F.lit(None).cast(feed.schema["displays"].dataType)).select(*feed.schema.names)
    lo, hi = log.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        feed.add(log.filter((F.col("ts") >= lo + i * step) & (F.col("ts") < lo + (i + 1) * step)))
    feed.rows(("sentinel", FAR, "x"))
    return log


def test_new_flag_parity(spark, feed, stages):
    fill(spark, feed)
    stages.run("out", stateful.repair_new_flag_stream(feed.stream(stages.session)))
    assert rows_of(stages.table("out")) == rows_of(logs.repair_new_flag(feed.table()))


def test_unique_visit_parity(spark, feed, stages):
    fill(spark, feed)
    stages.run("out", stateful.unique_visit_stream(feed.stream(stages.session)))
    assert rows_of(stages.table("out")) == rows_of(visits.unique_visit(feed.table()))


def test_unique_visits_meet_the_state_once_per_batch(feed, stages, monkeypatch):
    """The earliest of a batch, whatever Arrow batch it comes in, without a call of Python for each visitor."""
    monkeypatch.setattr(stateful, "TAKEN_IN", 2)
    stages.session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    day = 86_400_000
    feed.rows(*[(mid, T0 + ms, None) for ms in (9, 7, 8, 3, 5) for mid in ("a", None, "")], ("a", T0 + day + 1, None))
    feed.rows(("a", T0 + 1, None), ("b", T0 + 2, None), ("b", T0 + 1, None))
    visits_ = stateful.unique_visit_stream(feed.stream(stages.session))
    plan = visits_._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "TransformWithState" not in plan and "WithState" not in plan
    stages.run("out", visits_)
    got = sorted((r.common.mid or repr(r.common.mid), r.ts - T0) for r in stages.table("out").collect())
    assert got == sorted([("a", 3), ("None", 3), ("''", 3), ("a", day + 1), ("b", 1)])


def test_fates_parity(spark, feed, stages):
    fill(spark, feed)
    stages.run("out", stateful.entry_fates_stream(feed.stream(stages.session), tb.BOUNCE_WITHIN))
    assert rows_of(stages.table("out")) == rows_of(visits.entry_fates(feed.table(), tb.BOUNCE_WITHIN))


def test_visitor_chain_parity(spark, feed, stages):
    fill(spark, feed, parts=2)
    got = layers.stream_visitor_stats(stages, feed.stream(stages.session), tb.BOUNCE_WITHIN, "1 day")
    want = layers.visitor_stats(feed.table(), tb.BOUNCE_WITHIN, "1 day").filter("stt < '2030'")
    assert rows_of(got) == rows_of(want)


def test_product_stats_parity(spark, stages, tmp_path):
    lines = tb.order_detail(spark, SF_DIR).repartitionByRange(3, "create_at").sortWithinPartitions("create_at")
    path = str(tmp_path / "lines")
    lines.write.parquet(path)
    sentinel = lines.limit(1).withColumn("create_at", F.lit("2100-01-01 00:00:00").cast("timestamp"))
    sentinel.write.mode("append").parquet(path)
    stream = stages.session.readStream.schema(lines.schema).parquet(path)
    stages.run("out", stats.product_stats(stats.product_rows(orders=stream), "30 days"))
    want = stats.product_stats(stats.product_rows(orders=spark.read.parquet(path)), "30 days").filter("stt < '2050'")
    assert rows_of(stages.table("out")) == rows_of(want)


def test_interval_join_parity_and_eviction(spark, stages, tmp_path):
    """Both sides in time order, several batches: nothing is lost, and old state goes."""
    for name, df in (("o", tb.order_info(spark, SF_DIR)), ("d", tb.order_detail(spark, SF_DIR))):
        for i in range(3):
            lo, hi = f"{1995 + 3 * i}-01-01", f"{1998 + 3 * i}-01-01"
            part = df.filter((F.col("create_at") >= lo) & (F.col("create_at") < hi))
            part.coalesce(1).write.parquet(f"{tmp_path}/{name}-parts/{i}")
    feeds = {}
    for name, df in (("o", tb.order_info(spark, SF_DIR)), ("d", tb.order_detail(spark, SF_DIR))):
        os.makedirs(f"{tmp_path}/{name}")
        for i in range(3):
            folder = f"{tmp_path}/{name}-parts/{i}"
            file = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
            target = f"{tmp_path}/{name}/{i}.parquet"
            os.link(f"{folder}/{file}", target)
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
        feeds[name] = stages.session.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(
            f"{tmp_path}/{name}")
    bounds = (tb.ORDER_LOWER, tb.ORDER_UPPER)
    stages.run("out", wide.join_order_detail(feeds["o"], feeds["d"], *bounds))
    want = wide.join_order_detail(tb.order_info(spark, SF_DIR), tb.order_detail(spark, SF_DIR), *bounds)
    assert want.count() == 25
    assert rows_of(stages.table("out")) == rows_of(want)


def test_restart_takes_up_where_it_stopped(spark, feed, stages):
    """Second run from the same checkpoint: state is remembered and nothing comes twice."""
    day = 86_400_000
    start_of_day = T0 // day * day
    feed.rows(("a", start_of_day + 1, None, "1"), ("b", start_of_day + 2, None, "1"))
    for _ in range(2):
        stages.run("flag", stateful.repair_new_flag_stream(feed.stream(stages.session)))
        stages.run("visit", stateful.unique_visit_stream(feed.stream(stages.session)))
    feed.rows(("a", start_of_day + 3, None, "1"), ("c", start_of_day + 4, None, "1"))
    stages.run("flag", stateful.repair_new_flag_stream(feed.stream(stages.session)))
    stages.run("visit", stateful.unique_visit_stream(feed.stream(stages.session)))
    got = sorted((r.mid, r.is_new) for r in stages.table("flag").select("common.mid", "common.is_new").collect())
    assert got == [("a", "0"), ("a", "1"), ("b", "1"), ("c", "1")]
    assert sorted(r.mid for r in stages.table("visit").select("common.mid").collect()) == ["a", "b", "c"]


def test_bounce_state_survives_a_restart(spark, feed, stages):
    feed.rows(("a", T0, None), ("b", T0, None))
    stages.run("out", stateful.entry_fates_stream(feed.stream(stages.session)))
    assert stages.table("out").count() == 0
    feed.rows(("a", T0 + 5_000, "x"), ("b", T0 + 5_000, None))
    feed.rows(("z", T0 + 60_000, "x"))
    stages.run("out", stateful.entry_fates_stream(feed.stream(stages.session)))
    got = sorted((r.mid, r.ts - T0, r.fate) for r in stages.table("out").select("common.mid", "ts", "fate").collect())
    assert got == [("a", 0, "killed"), ("b", 0, "matched"), ("b", 5_000, "timeout")]


def test_disorder_within_the_delay_changes_nothing(spark, feed, stages):
    feed.rows(("a", T0 + 11_000, "x"), ("a", T0 + 3_000, None))
    feed.rows(("a", T0 + 10_000, None), ("a", T0 + 12_000, None))
    feed.rows(("a", T0 + 9_500, "y"))  # 2.5 s behind, but the watermark of the batch before allows it
    feed.rows(("z", FAR, "x"))
    stages.run("out", stateful.entry_fates_stream(feed.stream(stages.session)))
    assert rows_of(stages.table("out")) == rows_of(visits.entry_fates(feed.table().filter(F.col("ts") < FAR)))


def test_late_records_are_dropped(spark, feed, stages):
    feed.rows(("a", T0, None))
    feed.rows(("a", T0 + 100_000, None))
    feed.rows(("a", T0 + 100_001, None))
    feed.rows(("a", T0 + 1_000, None))  # far behind the watermark
    feed.rows(("z", FAR, "x"))
    log = feed.stream(stages.session)
    stages.run("out", stats.visitor_stats(log, log.filter("false"), log.filter("false"), "10 seconds"))
    assert stages.table("out").agg(F.sum("pv_ct")).first()[0] == 3


def test_open_windows_stay_open(spark, feed, stages):
    feed.rows(("a", T0, None))
    log = feed.stream(stages.session)
    stages.run("out", stats.visitor_stats(log, log.filter("false"), log.filter("false")))
    assert stages.table("out").count() == 0


def test_foreach_batch_sink_runs_with_a_checkpoint(spark, feed, tmp_path):
    feed.rows(("a", T0, None))
    seen = []
    stream = feed.stream(spark)
    q = start(stream.writeStream.foreachBatch(lambda df, i: seen.append((i, df.count()))), str(tmp_path / "cp"), once=True)
    q.awaitTermination()
    assert seen == [(0, 1)]


def change_files(folder, n, *rows):
    import json

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{n}.txt", "w") as f:
        for table, kind, seq, after in rows:
            f.write(json.dumps({"database": "shop", "tableName": table, "before": {}, "after": after, "type": kind,
                                "seq": seq}) + "\n")


def test_db_split_follows_the_config(spark, tmp_path):
    """A config row added between batches routes from then on, and its table is made."""
    from pyspark.sql import types as T

    config_rows = [("orders", "insert", "kafka", "dwd_orders", "id", None, None)]
    schema = T.StructType([*schemas.CHANGE.fields, T.StructField("seq", T.LongType())])
    folder = str(tmp_path / "in")

    def go():
        env, _ = parsing.parse_lines(file_topic(spark, folder), schema)
        refresh.db_split(env, lambda: spark.createDataFrame(config_rows, schemas.ROUTING), f"{tmp_path}/facts",
                         f"{tmp_path}/dims", f"{tmp_path}/cp", "seq", once=True).awaitTermination()

    change_files(folder, 1, ("orders", "insert", 1, {"id": "1", "x": "9"}), ("user", "insert", 2, {"id": "5", "n": "a"}))
    go()
    assert not os.path.exists(f"{tmp_path}/dims")
    config_rows.append(("user", "insert", "hbase", "dim_user", "id,n", None, None))
    config_rows.append(("user", "update", "hbase", "dim_user", "id,n", None, None))
    change_files(folder, 2, ("user", "insert", 3, {"id": "6", "n": "b"}), ("user", "update", 4, {"id": "6", "n": "c"}),
                 ("user", "delete", 5, {}))
    go()
    assert [tuple(r) for r in dims.read_dim(spark, f"{tmp_path}/dims/dim_user", "id").collect()] == [("6", "c")]
    facts = spark.read.text(f"{tmp_path}/facts")
    assert [(r.value, r.sink_table) for r in facts.collect()] == [('{"id":"1"}', "dwd_orders")]


def test_enrich_sees_the_newest_dimension(spark, feed, tmp_path):
    dims.create_dim(spark, f"{tmp_path}/dim", "id,name")
    for batch, name in enumerate(("old", "new")):
        dims.append_changes(spark.createDataFrame([("a", name, 1)], "id string, name string, seq int"),
                            f"{tmp_path}/dim", batch, "id", "seq")
        feed.rows(("a", T0 + batch, None))
        stream = feed.stream(spark).select("ts", F.col("common.mid").alias("mid"))
        refresh.enrich(stream, lambda: dims.read_dim(spark, f"{tmp_path}/dim", "id"),
                       lambda df, dim: joins.dim_join(df, dim, "mid", {"name": "name"}), f"{tmp_path}/out",
                       f"{tmp_path}/cp", once=True).awaitTermination()
    got = sorted((r.ts - T0, r.name) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(0, "old"), (1, "new")]


def test_keep_running_starts_again(spark, feed, tmp_path):
    feed.rows(("a", T0, None))
    tries = []

    def flaky(df, batch_id):
        tries.append(batch_id)
        if len(tries) < 3:
            raise ValueError("not yet")

    refresh.keep_running(lambda: start(feed.stream(spark).writeStream.foreachBatch(flaky), f"{tmp_path}/cp", once=True),
                         attempts=3, pause_seconds=0)
    assert tries == [0, 0, 0]
    with pytest.raises(Exception):
        refresh.keep_running(lambda: start(feed.stream(spark).writeStream.foreachBatch(lambda d, i: 1 / 0),
                                           f"{tmp_path}/cp2", once=True), attempts=1, pause_seconds=0)


def test_late_data_keeps_the_logs_partitions(spark, monkeypatch):
    from pathlib import Path

    from rillmart.plans import catalog

    places, log = [], catalog.tb.app_log

    class Noted(catalog.Stages):
        def __init__(self, *a, **k):
            super().__init__(*a, **k)
            places.append(self.path("in/0"))

    folder = "/root/testdata/sf0.001"
    want = sorted(map(tuple, catalog.stream_late_data(spark, folder).collect()))
    monkeypatch.setattr(catalog, "Stages", Noted)
    monkeypatch.setattr(catalog.tb, "app_log", lambda *a: log(*a).repartition(3))
    assert sorted(map(tuple, catalog.stream_late_data(spark, folder).collect())) == want
    assert len(list(Path(places[0].removeprefix("file:")).glob("*.parquet"))) > 1


def test_each_source_has_its_own_watermark(spark, tmp_path):
    """A silent source holds nobody, one that is years ahead makes nobody late, and a beat closes what a source left open."""
    stages = Stages(spark, "test", folder=str(tmp_path / "out"), state_partitions=2)
    schema = "sku_id bigint, create_time string, create_at timestamp"

    def feed(name, *rows):
        spark.createDataFrame([(sku, t) for sku, t in rows], "sku_id bigint, create_time string").withColumn(
            "create_at", F.col("create_time").cast("timestamp")).write.mode("append").parquet(stages.path(f"in/{name}"))

    def stream(name):
        stages.make_folder(stages.path(f"in/{name}"))
        return stages.session.readStream.schema(schema).parquet(stages.path(f"in/{name}"))

    merged = layers.product_sources(stages, "10 seconds", {"cart": "1 hour"}, favor=stream("favor"), cart=stream("cart"), comments=stream("comments").withColumn(
        "appraise", F.lit("1201")))

    def got():
        return sorted((r.stt, r.sku_id, r.favor_ct, r.cart_ct) for r in merged.table().collect())

    feed("favor", (1, "2020-01-01 00:00:01"), (1, "2020-01-01 00:00:02"), (2, "2020-01-01 00:05:00"))
    feed("cart", (1, "2030-01-01 00:00:00"))
    merged.run()
    assert got() == [("2020-01-01 00:00:00", 1, 2, 0)]
    feed("favor", (None, "2020-01-01 00:10:00"), (1, "2020-01-01 00:00:03"))  # the second is late in its own source
    feed("cart", (2, "2029-12-31 23:30:00"), (1, "2020-01-01 00:00:04"))  # the first is within the hour
    merged.run()
    assert got() == [("2020-01-01 00:00:00", 1, 2, 0), ("2020-01-01 00:05:00", 2, 1, 0)]
    merged.beat("cart", "2031-01-01 00:00:00")
    merged.beat("favor", "2031-01-01 00:00:00")
    merged.run()
    want = [("2020-01-01 00:00:00", 1, 2, 0), ("2020-01-01 00:05:00", 2, 1, 0), ("2020-01-01 00:10:00", None, 1, 0),
            ("2029-12-31 23:30:00", 2, 0, 1), ("2030-01-01 00:00:00", 1, 0, 1)]
    assert sorted(got(), key=str) == want
    merged.run()
    assert sorted(got(), key=str) == want


def test_partial_sums_of_a_window_meet(spark, tmp_path):
    """Two sources close the same window in different rounds; a batch of the merge that runs again changes nothing."""
    stages = Stages(spark, "test", folder=str(tmp_path / "out"), state_partitions=2)
    at = F.lit("2020-01-01 00:00:01").cast("timestamp")
    one = spark.range(3).select(F.lit(1).cast("bigint").alias("sku_id"), at.alias("create_at"))
    for name in ("favor", "cart"):
        one.write.parquet(stages.path(f"in/{name}"))
    streams = {n: stages.session.readStream.schema(one.schema).parquet(stages.path(f"in/{n}")) for n in ("favor", "cart")}
    merged = layers.product_sources(stages, "10 seconds", {}, **streams)
    for source, want in (("cart", (0, 3)), ("favor", (3, 3))):
        merged.beat(source, "2021-01-01 00:00:00")
        merged.run()
        assert [(r.favor_ct, r.cart_ct) for r in merged.table().collect()] == [want]
