"""Topics, dimension tables and stats tables."""

import os
import time

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import logs, parsing, reports, routing
from rillmart.sinks import dims, stats as stats_sink, topics
from rillmart.sources import changes, testbed as tb
from rillmart.sources.tables import for_day, read_table, stream_table
from rillmart.sources.topics import file_topic, topic_table

from .conftest import SF_DIR


def run(query):
    query.awaitTermination()


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_lines_from_folder_to_parsed_topic(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", ['{"common":{"mid":"1"},"ts":5}', "broken"])
    good, dirty = parsing.parse_lines(file_topic(spark, str(tmp_path / "in")), schemas.PAGE_LOG, ("common.mid",))
    run(topics.to_topic(good, f"{tmp_path}/good", f"{tmp_path}/c1", once=True))
    run(topics.to_topic(dirty, f"{tmp_path}/dirty", f"{tmp_path}/c2", "text", once=True))
    assert spark.read.parquet(f"{tmp_path}/good").count() == 1
    assert [r.value for r in spark.read.text(f"{tmp_path}/dirty").collect()] == ["broken"]
    assert file_topic(spark, str(tmp_path / "in"), stream=False).count() == 2


def test_json_topic_read_back(spark, tmp_path):
    log = stream_table(spark, SF_DIR, "nation")
    run(topics.json_topic(log, f"{tmp_path}/json", f"{tmp_path}/c", once=True))
    back = spark.read.schema("n_nationkey int, n_name string").json(f"{tmp_path}/json")
    assert back.count() == 25 and back.filter("n_name = 'NATION_7'").first().n_nationkey == 7


def test_routed_topics_have_a_folder_each(spark, tmp_path):
    log = tb.app_log_stream(spark, SF_DIR)
    run(topics.to_routed_topics(logs.routed_log(log), f"{tmp_path}/t", f"{tmp_path}/c", once=True))
    folders = sorted(f for f in os.listdir(f"{tmp_path}/t") if f.startswith("sink_table="))
    assert folders == ["sink_table=dwd_display_log", "sink_table=dwd_page_log", "sink_table=dwd_start_log"]
    first = spark.read.schema(schemas.PAGE_LOG).json(f"{tmp_path}/t/sink_table=dwd_page_log").filter("start is null")
    assert first.count() == logs.page_log(tb.app_log(spark, SF_DIR)).count()


def test_tee_writes_both_copies(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", ["a", "b"])
    run(topics.tee(file_topic(spark, str(tmp_path / "in")), f"{tmp_path}/ods", f"{tmp_path}/daily", f"{tmp_path}/c",
                   once=True))
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/ods").collect()) == ["a", "b"]
    copy = spark.read.text(f"{tmp_path}/daily")
    assert copy.count() == 2 and "day" in copy.columns


def test_console(spark, tmp_path):
    run(topics.to_console(stream_table(spark, SF_DIR, "region"), f"{tmp_path}/c", once=True))


def test_change_lines_latest_skips_older_files(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", ["old"])
    os.utime(tmp_path / "in" / "1.txt", (1_600_000_000, 1_600_000_000))
    write_lines(tmp_path / "in", "2.txt", ["new"])
    for startup, want in (("initial", ["new", "old"]), ("latest", ["new"])):
        lines = changes.change_lines(spark, str(tmp_path / "in"), startup, since="2022-01-01 00:00:00")
        run(topics.to_topic(lines, f"{tmp_path}/{startup}", f"{tmp_path}/c-{startup}", "text", once=True))
        assert sorted(r.value for r in spark.read.text(f"{tmp_path}/{startup}").collect()) == want
    with pytest.raises(ValueError):
        changes.change_lines(spark, str(tmp_path / "in"), "sometime")


def test_change_lines_latest_keeps_files_across_a_restart(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", ["old"])
    os.utime(tmp_path / "in" / "1.txt", (1_600_000_000, 1_600_000_000))

    def once():
        lines = changes.change_lines(spark, str(tmp_path / "in"), "latest", checkpoint=f"{tmp_path}/c")
        run(topics.to_topic(lines, f"{tmp_path}/out", f"{tmp_path}/c", "text", once=True))
        return sorted(r.value for r in spark.read.schema("value string").text(f"{tmp_path}/out").collect())

    assert once() == []
    write_lines(tmp_path / "in", "2.txt", ["came while down"])
    later = time.time() + 5
    os.utime(tmp_path / "in" / "2.txt", (later, later))
    assert once() == ["came while down"]
    with pytest.raises(ValueError):
        changes.change_lines(spark, str(tmp_path / "in"), "latest")


def test_topic_table_as_view(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", ['{"page":{"item":"x"},"ts":1700000000000}', '{"page":{},"ts":1700000000001}'])
    topic_table(file_topic(spark, str(tmp_path / "in"), stream=False), "page map<string,string>, ts bigint",
                F.timestamp_millis("ts"), view="page_log_view")
    got = spark.sql("select page['item'] as item, rt from page_log_view where page['item'] is not null").collect()
    assert len(got) == 1 and got[0].item == "x" and got[0].rt.year == 2023


# --- dimension tables -----------------------------------------------------------

def rows(spark, path):
    return sorted(tuple(r) for r in dims.read_dim(spark, path, "id").select("id", "name").collect())


def change(spark, *items):
    return spark.createDataFrame(list(items), "id string, name string, seq int")


def test_dim_table_life(spark, tmp_path):
    path = f"{tmp_path}/dim"
    with pytest.raises(FileNotFoundError):
        dims.read_dim(spark, path, "id")
    assert dims.create_dim(spark, path, "id,name") and not dims.create_dim(spark, path, "id,name")
    assert rows(spark, path) == []
    dims.append_changes(change(spark, ("1", "a", 1), ("2", "b", 1), ("1", "c", 2)), path, 0, "id", "seq")
    assert rows(spark, path) == [("1", "c"), ("2", "b")]
    held = dims.read_dim(spark, path, "id")
    dims.append_changes(change(spark, ("2", "d", 1), ("10", "e", 1)), path, 11, "id", "seq")
    dims.append_changes(change(spark, ("2", "f", 1)), path, 2, "id", "seq")  # numbers, not texts, decide
    want = [("1", "c"), ("10", "e"), ("2", "d")]
    assert rows(spark, path) == want
    dims.append_changes(change(spark, ("2", "d", 1), ("10", "e", 1)), path, 11, "id", "seq")  # run again
    assert rows(spark, path) == want
    assert dims.compact(spark, path, "id") == 11 and rows(spark, path) == want
    assert dims.compact(spark, path, "id") == 11
    assert held.count() == 2
    dims.append_changes(change(spark, ("3", "g", 1)), path, 12, "id", "seq")
    assert len(rows(spark, path)) == 4


def test_unfinished_batch_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/dim"
    dims.create_dim(spark, path, "id,name")
    dims.append_changes(change(spark, ("1", "a", 1)), path, 0, "id", "seq")
    dims.append_changes(change(spark, ("1", "b", 1)), path, 1, "id", "seq")
    os.rename(f"{path}/changes/batch=1/_SUCCESS", f"{tmp_path}/mark")
    assert rows(spark, path) == [("1", "a")]


def test_dim_schema_and_config(spark, tmp_path):
    assert dims.dim_schema("a,b").names == ["id", "a", "b"]
    assert dims.dim_schema("a,b", "b").names == ["a", "b"]
    assert dims.create_from_config(spark, str(tmp_path), tb.routing(spark)) == ["dim_customer"]
    assert dims.create_from_config(spark, str(tmp_path), tb.routing(spark)) == []
    assert dims.read_dim(spark, f"{tmp_path}/dim_customer", "c_custkey").columns == ["c_custkey", "c_name", "c_mktsegment"]


def test_stream_dims_applies_each_batch(spark, tmp_path):
    schema = "sinkType string, sinkTable string, after map<string,string>, seq int"
    src = f"{tmp_path}/src"
    for name in ("a", "b"):
        spark.createDataFrame([("hbase", "dim_x", {"id": "1", "name": name}, 1), ("kafka", "f", {"id": "9"}, 1)],
                              schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        run(dims.stream_dims(stream, str(tmp_path), {"dim_x": (["id", "name"], "id")}, f"{tmp_path}/c", "seq", once=True))
        if name == "a":
            dims.create_dim(spark, f"{tmp_path}/dim_x", "id,name")
        assert rows(spark, f"{tmp_path}/dim_x") == [("1", name)]


def after(spark, *items):
    return spark.createDataFrame(list(items), "sinkType string, sinkTable string, after map<string,string>, seq int")


def test_a_change_sets_only_the_columns_it_holds(spark, tmp_path):
    path = f"{tmp_path}/dim_x"
    dims.create_dim(spark, path, "id,name,city")
    table = {"dim_x": (["id", "name", "city"], "id")}
    dims.write_batch(after(spark, ("hbase", "dim_x", {"id": "1", "name": "a", "city": "X"}, 1), ("hbase", "dim_x", {"id": "2", "name": "n"}, 1)), str(tmp_path), table, 0, "seq", 9)
    # Two changes of one key in one batch each set a column of their own; the newer one wins where both do.
    dims.write_batch(after(spark, ("hbase", "dim_x", {"id": "1", "name": "b"}, 3), ("hbase", "dim_x", {"id": "1", "name": "old", "city": "Y"}, 2)), str(tmp_path), table, 1, "seq", 9)
    state = {r.id: (r.name, r.city) for r in dims.read_dim(spark, path, "id").collect()}
    assert state == {"1": ("b", "Y"), "2": ("n", None)}
    # A column a later config adds is seen from then on, also through a new base.
    more = {"dim_x": (["id", "name", "city", "zip"], "id")}
    dims.write_batch(after(spark, ("hbase", "dim_x", {"id": "2", "zip": "9"}, 1)), str(tmp_path), more, 2, "seq", 9)
    want = {"1": ("b", "Y", None), "2": ("n", None, "9")}
    assert {r.id: (r.name, r.city, r.zip) for r in dims.read_dim(spark, path, "id").collect()} == want
    dims.compact(spark, path, "id")
    assert {r.id: (r.name, r.city, r.zip) for r in dims.read_dim(spark, path, "id").collect()} == want


def test_changes_are_folded_and_old_folders_go(spark, tmp_path):
    path, table = f"{tmp_path}/dim_x", {"dim_x": (["id", "name"], "id")}
    dims.create_dim(spark, path, "id,name")
    for n in range(7):
        dims.write_batch(after(spark, ("hbase", "dim_x", {"id": str(n % 3), "name": f"n{n}"}, 1)), str(tmp_path), table, n, "seq", 3)
        dims.write_batch(after(spark, ("hbase", "dim_y", {"id": "1"}, 1)), str(tmp_path), table, 100 + n, "seq", 3)
    assert rows(spark, path) == [("0", "n6"), ("1", "n4"), ("2", "n5")]
    assert len(os.listdir(f"{path}/changes")) < 7 and not any(n.endswith("=100") for n in os.listdir(f"{path}/changes"))


def test_tables_of_a_config_have_the_columns_of_all_operations(spark):
    config = tb.routing(spark, [("t", "insert", "hbase", "dim_x", "id,name,city", "id", None), ("t", "update", "hbase", "dim_x", "id,name,zip", None, None),
                                ("u", "insert", "kafka", "f", "id", None, None)])
    columns, key = dims.config_tables(config)["dim_x"]
    assert sorted(columns.split(",")) == ["city", "id", "name", "zip"] and key == "id" and len(dims.config_tables(config)) == 1


# --- stats tables ------------------------------------------------------------------

def test_stats_table_is_pruned_by_day(spark, tmp_path):
    path = f"{tmp_path}/stats"
    data = spark.createDataFrame([("2024-01-05 00:00:00", "e", 1), ("2024-01-06 00:00:00", "e", 2)],
                                 "stt string, edt string, order_amount int")
    stats_sink.save_stats(data, path, ["stt", "edt", "order_amount"])
    table = spark.read.parquet(path)
    day = for_day(table, 20240106)
    assert day.count() == 1 and reports.gmv(table, 20240106).first().gmv == 2.0
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()
    assert for_day(data, 20240105).count() == 1 and for_day(data, None).count() == 2


def test_stream_stats(spark, tmp_path):
    schema = "stt string, edt string, ct int, extra int"
    spark.createDataFrame([("2024-01-05 00:00:00", "e", 1, 5)], schema).write.parquet(f"{tmp_path}/src")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/src")
    run(stats_sink.stream_stats(stream, f"{tmp_path}/out", ["stt", "edt", "ct"], f"{tmp_path}/c", once=True))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.columns == ["stt", "edt", "ct", "dt"] and out.first().dt == 20240105


def test_plans_keep_scans_narrow(spark):
    """Filters and columns reach the scan; row limits come before the shuffle."""
    from rillmart.operators import visits

    plan = logs.first_claims(tb.app_log(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "value:double" not in scan and "props" not in scan
    assert plan.count("WindowGroupLimit") == 2
    assert visits.unique_visit(tb.app_log(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString().count(
        "WindowGroupLimit") == 2
    orders = read_table(spark, SF_DIR, "lineitem").filter("l_returnflag = 'R'")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in (
        orders._jdf.queryExecution().executedPlan().toString())
    assert routing.newest(read_table(spark, SF_DIR, "orders"), "o_custkey", "o_orderkey")._jdf.queryExecution(
    ).executedPlan().toString().count("WindowGroupLimit") == 2
