"""Tables dealt into buckets: a batch reads and rewrites the buckets of its keys only."""

import os

import pytest
from pyspark.sql import functions as F

from rillmart.sinks import buckets
from rillmart.sinks.parts import PART, load_state, newest_state, read_parts, replace_parts, states

N = 16


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def table(spark, path, rows=400):
    base = spark.range(rows).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("n"), "id").alias("name"), F.lit("old").alias("seg"))
    buckets.make_table(base, path, "id", N)
    return {str(i): (f"n{i}", "old") for i in range(rows)}


def changes(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, seg string, seq long, _present array<string>")


def held(spark, path):
    return {r.id: (r.name, r.seg) for r in buckets.read_table(spark, path).collect()}


def test_a_batch_rewrites_the_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    want = table(spark, path)
    before, first = files(path), newest_state(spark, path)
    assert len(first.parts) == N and not buckets.make_table(spark.range(1), path, "id", 3)
    buckets.apply_changes(changes(spark, [("7", None, "new", 1, ["seg"]), ("7", None, "newer", 2, ["seg"]), ("x", "nx", None, 1, ["name", "seg"])]), path, 0, "seq")
    want |= {"7": ("n7", "newer"), "x": ("nx", None)}
    assert held(spark, path) == want
    after, state = files(path), newest_state(spark, path)
    moved = {p for p, b in state.parts.items() if b == 0}
    assert 1 <= len(moved) <= 2
    assert {f: t for f, t in after.items() if "batch=-1" in f} == before  # the rest was not written again
    assert len(after) - len(before) == len(moved)
    # What the batch read: the folders of these buckets and nothing else.
    read = {f.rsplit("/", 2)[1] for f in read_parts(spark, path, first, moved).inputFiles()}
    assert read == {f"{PART}={p}" for p in moved}


def test_batches_equal_an_upsert_of_all_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    want = table(spark, path, 50)
    for n in range(4):
        rows = [(str(i), f"b{n}", f"s{n}.{i}", k, ["name"] if i % 2 else ["name", "seg"]) for k, i in enumerate(range(n, 80, 5 + n))]
        buckets.apply_changes(changes(spark, rows), path, n, "seq")
        for i, name, seg, _, present in rows:
            want[i] = (name, seg if "seg" in present else want.get(i, (None, None))[1])
    assert held(spark, path) == want
    assert states(spark, path) == [2, 3]  # older states and what only they name are gone
    used = {f for n in (2, 3) for f in load_state(spark, path, n).folders(path)}
    assert {os.path.dirname(f) for f in files(path)} == used


def test_a_repeated_batch_and_one_cut_short(spark, tmp_path):
    path = str(tmp_path / "t")
    want = table(spark, path, 20)
    one = changes(spark, [("3", "a", "b", 1, ["name", "seg"])])
    # Cut short: data are there, the state is not.
    one.withColumn(PART, F.lit(0)).write.partitionBy(PART).parquet(f"{path}/data/batch=0")
    assert held(spark, path) == want
    buckets.apply_changes(one, path, 0, "seq")
    want["3"] = ("a", "b")
    assert held(spark, path) == want
    seen = files(path)
    buckets.apply_changes(one, path, 0, "seq")
    assert files(path) == seen and held(spark, path) == want
    buckets.apply_changes(changes(spark, []), path, 1, "seq")  # nothing changes
    buckets.apply_changes(changes(spark, [(None, "a", "b", 1, ["name"])]), path, 2, "seq")
    assert held(spark, path) == want
    with pytest.raises(ValueError):
        replace_parts(spark, path, -5, [], lambda _: None)


def test_columns_added_later_and_keys_of_other_types(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.make_table(spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"), path, "id", 4)
    buckets.apply_changes(spark.createDataFrame([("2", "red", 1)], "id string, colour string, seq long"), path, 0, "seq")
    rows = {r.id: (r.name, r.colour) for r in buckets.read_table(spark, path).collect()}
    assert rows == {1: ("a", None), 2: ("b", "red")}
    found = buckets.read_keys(spark, path, spark.createDataFrame([("2",), ("9",)], "id string"))
    assert [(r.id, r.colour) for r in found.collect()] == [(2, "red")]
    assert len(found.inputFiles()) <= 2
    with pytest.raises(FileNotFoundError):
        buckets.read_table(spark, f"{tmp_path}/none")


def test_an_empty_table_fills_by_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.make_table(spark.createDataFrame([], "id string, name string, seg string"), path, "id", 4)
    assert held(spark, path) == {}
    buckets.apply_changes(changes(spark, [("1", "a", "b", 1, ["name"])]), path, 0, "seq")
    assert held(spark, path) == {"1": ("a", None)}


def test_a_stream_of_changes(spark, tmp_path):
    path, given = str(tmp_path / "t"), f"{tmp_path}/in"
    want = table(spark, path, 30)
    for n in range(3):
        changes(spark, [(str(5 * n + k), f"v{n}", None, k, ["name"]) for k in range(8)]).write.mode("append").parquet(given)
        stream = spark.readStream.schema("id string, name string, seg string, seq long, _present array<string>").parquet(given)
        buckets.stream_changes(stream, path, "seq", f"{tmp_path}/c", once=True).awaitTermination()
        want |= {str(5 * n + k): (f"v{n}", "old") for k in range(8)}
    assert held(spark, path) == want
