"""Tables by day: files that come, go or change rebuild their days alone."""

import os

import pytest
from pyspark.sql import functions as F

from rillmart.functions.timefns import stamp, yyyymmdd
from rillmart.sinks import days
from rillmart.sinks.kept import kept_table
from rillmart.sinks.parts import newest_state


@pytest.fixture
def kept(spark, tmp_path):
    """(write a file of (time, amount) rows, refresh, the table as {day: (records, sum)}, days built so far)."""
    folder, path, built = f"{tmp_path}/in", f"{tmp_path}/t", []
    os.makedirs(folder)

    def write(name, rows):
        df = spark.createDataFrame(rows, "at string, amount long").select(F.to_timestamp("at").alias("ts"), "amount")
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")

    def build(changed):
        built.append(changed)
        rows = spark.read.schema("ts timestamp, amount long").option("recursiveFileLookup", "true").parquet(folder)
        found = rows.filter(days.in_days("ts", changed)).groupBy(F.window("ts", "1 day")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
        return found.select(stamp("window.start").alias("stt"), "n", "total")

    def refresh(version="1"):
        source = days.Input("log", folder, lambda rows: F.array_compact(F.array(yyyymmdd("ts"))))
        return days.refresh(spark, path, [source], build, version)

    def table(only=None):
        return {r.dt: (r.n, r.total) for r in days.read_days(spark, path, only).collect()}

    return write, refresh, table, path, folder


def test_a_file_rebuilds_its_days_alone(spark, kept):
    write, refresh, table, path, _ = kept
    write("a", [("2024-01-01 10:00:00", 1), ("2024-01-02 11:00:00", 2)])
    write("b", [("2024-01-03 23:59:59", 4)])
    assert refresh() == [20240101, 20240102, 20240103]
    assert table() == {20240101: (1, 1), 20240102: (1, 2), 20240103: (1, 4)}
    assert refresh() == [] and newest_state(spark, path).number == 0
    write("c", [("2024-01-02 00:00:00", 8), ("2024-01-05 00:00:00", 16)])
    assert refresh() == [20240102, 20240105]
    assert table() == {20240101: (1, 1), 20240102: (2, 10), 20240103: (1, 4), 20240105: (1, 16)}
    assert newest_state(spark, path).parts == {20240101: 0, 20240102: 1, 20240103: 0, 20240105: 1}
    one = days.read_days(spark, path, [20240103])
    assert len(one.inputFiles()) == 1 and table([20240103, 20240104]) == {20240103: (1, 4)}


def test_files_that_go_or_change(spark, kept):
    write, refresh, table, path, folder = kept
    write("a", [("2024-01-01 10:00:00", 1), ("2024-01-02 11:00:00", 2)])
    write("b", [("2024-01-02 12:00:00", 4), ("2024-01-09 12:00:00", 4)])
    refresh()
    write("b", [("2024-01-02 12:00:00", 5), ("2024-01-03 12:00:00", 6)])  # replaced: its old days and its new ones
    assert refresh() == [20240102, 20240103, 20240109]
    assert table() == {20240101: (1, 1), 20240102: (2, 7), 20240103: (1, 6)}
    for f in os.listdir(f"{folder}/a"):
        os.remove(f"{folder}/a/{f}")
    assert refresh() == [20240101, 20240102]
    assert table() == {20240102: (1, 5), 20240103: (1, 6)}


def test_another_version_rebuilds_all_days(spark, kept):
    write, refresh, table, path, _ = kept
    write("a", [("2024-01-01 10:00:00", 1), ("2024-01-02 11:00:00", 2)])
    assert refresh("1") == refresh("2") == [20240101, 20240102]
    assert refresh("2") == [] and set(newest_state(spark, path).parts.values()) == {1}


def test_empty_files_and_times_that_are_missing(spark, kept):
    write, refresh, table, path, _ = kept
    write("a", [])
    assert refresh() == [] and table() == {}
    write("b", [(None, 3)])
    assert refresh() == [] and refresh() == [] and table() == {}
    write("c", [("2024-01-01 10:00:00", 1), (None, 2)])
    assert refresh() == [20240101] and table() == {20240101: (1, 1)}


def test_a_kept_table_goes_by_its_bounds_too(spark, tmp_path):
    folder = f"{tmp_path}/in"
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    def times(n):
        return kept_table(spark, folder, "times", ("t",), lambda: spark.read.parquet(f"{folder}/t.parquet").selectExpr(f"id * {n} as id"), settings=(n,))

    assert sorted(r.id for r in times(2).collect()) == [0, 2, 4]
    assert sorted(r.id for r in times(3).collect()) == [0, 3, 6]
    assert times(2).inputFiles() == times(2).inputFiles() != times(3).inputFiles()


def test_sessions_that_build_at_once_do_not_meet(spark, tmp_path):
    folder, inner = f"{tmp_path}/in", []
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    read = lambda: spark.read.parquet(f"{folder}/t.parquet")

    def build():
        if not inner:  # another session builds the same table while this one does
            inner.append(None)
            inner[0] = kept_table(spark, folder, "both", ("t",), read)
        return read()

    first = kept_table(spark, folder, "both", ("t",), build)
    assert first.count() == inner[0].count() == 3
    assert kept_table(spark, folder, "both", ("t",), lambda: pytest.fail("built again")).count() == 3


def test_a_large_input_is_built_in_more_partitions(spark, tmp_path, monkeypatch):
    """What one task sorts must not grow with the input, and a day must not be a file of each of these tasks."""
    from rillmart.sinks import kept

    folder, seen = str(tmp_path), []
    spark.range(1000).repartition(2).write.parquet(f"{folder}/t.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "t.parquet").glob("*.parquet"))
    monkeypatch.setattr(kept, "PARTITION_BYTES", size // 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def build():
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return spark.read.parquet(f"{folder}/t.parquet").repartition(20, "id").selectExpr("'2024-01-01 00:00:00' as stt", "id")

    table = kept.kept_table(spark, folder, "wide", ("t",), build, by_day=True)
    assert seen[0] >= 20 and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert table.count() == 1000 and len(table.inputFiles()) == 1
