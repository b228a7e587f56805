"""Versions as of a time against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import asof, routing

T0 = datetime(2020, 1, 1)


def newest(versions, key, time):
    """(b, a) of the newest version at a time."""
    fit = [(since, b, a) for k, since, a, b in versions if k == key and k is not None and since is not None and time is not None and since <= time]
    return max(fit, default=(None, None, None))[1:]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("width", [timedelta(seconds=7), timedelta(days=30)])
def test_as_of_join(spark, how, width):
    r = random.Random(4)
    times = [T0 + timedelta(seconds=r.randrange(-50, 50)) for _ in range(60)] + [None]
    versions = [(r.choice(["a", "b", "hot", "hot", None]), t, r.randrange(3), r.choice(["x", "y"])) for t in times for _ in range(2)]
    records = [(i, r.choice(["a", "b", "hot", "hot", "hot", "none", None]), r.choice([*times, T0 + timedelta(days=400)])) for i in range(300)]
    known = spark.createDataFrame(versions, "id string, since timestamp, a int, b string")
    rows = spark.createDataFrame([(*x, "own k", "own s") for x in records], "n int, who string, made timestamp, k string, s string").withColumn("b", F.lit("old"))
    out = asof.as_of_join(rows, known, "who", "made", {"b": "b", "first": "a"}, how, width=width)
    assert out.columns == ["n", "who", "made", "k", "s", "b", "first"]
    want = [(n, *newest(versions, who, made)) for n, who, made in records]
    want = [w for w in want if how == "left" or w[1] is not None]
    assert sorted(((x.n, x.b, x.first) for x in out.collect()), key=str) == sorted(want, key=str)


def test_no_versions_and_no_records(spark):
    known = spark.createDataFrame([], "id string, since timestamp, a int")
    rows = spark.createDataFrame([("x", T0)], "who string, made timestamp")
    assert asof.as_of_join(rows, known, "who", "made", {"a": "a"}).count() == 0
    assert [r.a for r in asof.as_of_join(rows, known, "who", "made", {"a": "a"}, "left").collect()] == [None]
    assert asof.as_of_join(rows.limit(0), known, "who", "made", {"a": "a"}, "left").count() == 0


def test_a_hot_key_is_never_gathered(spark):
    """Windows run over a row per key and slice, or over one slice of one key."""
    known = spark.range(10).select(F.lit("u").alias("id"), F.timestamp_seconds("id").alias("since"), F.col("id").alias("a"))
    rows = spark.range(10).select(F.lit("u").alias("who"), F.timestamp_seconds("id").alias("made"))
    plan = asof.as_of_join(rows, known, "who", "made", {"a": "a"})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line or line.strip().startswith("Window [")]
    assert len(windows) == 2
    # The one by key alone stands over distinct (key, slice) rows.
    assert plan.count("Aggregate") >= 3


def test_route_as_of(spark):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ROUTING.fields)

    def rule(table, columns, at, change="update"):
        return ("orders", "insert", "kafka", table, columns, None, None, None if at is None else T0 + timedelta(hours=at), change)

    versions = spark.createDataFrame([
        rule("one", "id", 0), rule("two", "id,x", 5), rule(None, None, 8, "delete"), rule("three", "x", 10), rule("never", "x", None),
        rule("tie", "id", 20), rule(None, None, 20, "delete")], f"{fields}, since timestamp, change string")
    changes = spark.createDataFrame([
        ("orders", kind, {"id": str(h), "x": "9"}, None if h is None else T0 + timedelta(hours=h))
        for kind, h in [("insert", -1), ("insert", 0), ("insert", 4), ("insert", 5), ("insert", 8), ("insert", 9), ("insert", 10), ("insert", 21), ("insert", None),
                        ("delete", 3), ("update", 3)]], "tableName string, type string, after map<string,string>, at timestamp")
    got = sorted((r.sinkTable, tuple(sorted(r.after.items()))) for r in routing.route_as_of(changes, versions, "at").collect())
    x = ("x", "9")
    assert got == [("one", (("id", "0"),)), ("one", (("id", "4"),)), ("three", (x,)), ("tie", (("id", "21"),)), ("two", (("id", "5"), x))]


def test_changes_stay_where_they_are(spark):
    """Dealt out by table and operation, all inserts of one table would be one task's; so it was where plans do not adapt, as in a stream's batch."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    config = spark.createDataFrame([("orders", "insert", "kafka", "facts", "id", None, None)], schemas.ROUTING)
    changes = spark.createDataFrame([("orders", "insert", {"id": "1"})], "tableName string, type string, after map<string,string>")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "262144")
        routed = routing.route_changes(changes, config)
        assert "hashpartitioning" not in routed._jdf.queryExecution().executedPlan().toString()
        assert [r.after for r in routed.collect()] == [{"id": "1"}]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
