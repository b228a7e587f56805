"""Joins and sums of streams by batch plans: several batches, late records, restarts, what stays on disk."""

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rillmart.operators import joins, stats
from rillmart.plans import layers
from rillmart.streaming import batched
from rillmart.streaming.jobs import Stages

LOWER, UPPER = timedelta(seconds=-5), timedelta(seconds=10)


@pytest.fixture
def stages(spark, tmp_path):
    return Stages(spark, "test", folder=str(tmp_path / "out"), state_partitions=2)


def at(seconds):
    return f"2020-01-01 00:{seconds // 60:02d}:{seconds % 60:02d}"


class Sides:
    """Two streams of (k, id, seconds), one file a batch."""

    def __init__(self, spark, stages, delay="1 millisecond"):
        self.spark, self.stages, self.n = spark, stages, 0
        for name in ("l", "r"):
            stages.make_folder(stages.path(f"in/{name}"))
        self.sides = [batched.Side(self.stream(name), F.col(f"{name}t"), delay) for name in ("l", "r")]

    def schema(self, name):
        return f"{name}k string, {name}id int, {name}t timestamp"

    def stream(self, name):
        return self.stages.session.readStream.schema(self.schema(name)).parquet(self.stages.path(f"in/{name}"))

    def feed(self, **rows):
        for name, of_side in rows.items():
            texts = self.spark.createDataFrame([(k, i, None if s is None else at(s)) for k, i, s in of_side], "k string, i int, t string")
            names = [c.split()[0] for c in self.schema(name).split(", ")]
            texts.select("k", "i", F.col("t").cast("timestamp")).toDF(*names).coalesce(1).write.mode("append").parquet(self.stages.path(f"in/{name}"))

    def join(self, l, r):
        return joins.interval_join(l, r, "lk", "rk", "lt", "rt", LOWER, UPPER)

    def run(self):
        self.stages.run_pairs("pairs", *self.sides, LOWER, UPPER, self.join)

    def got(self):
        return sorted((r.lid, r.rid) for r in self.stages.table("pairs").collect())

    def open(self):
        newest = max(Path(self.stages.path("open/pairs/state")).glob("batch=*"), key=lambda p: int(p.name[6:]))
        return sorted(tuple(r) for r in self.spark.read.parquet(str(newest)).filter("mark is null").select(
            "_side", F.coalesce("l.lid", "r.rid")).collect())


def test_pairs_over_batches(spark, stages):
    """Pairs of rows of one batch and of different batches come once, bounds are inclusive, and only what can still meet is kept."""
    sides = Sides(spark, stages)
    sides.feed(l=[("a", 1, 20), ("a", 2, 30), (None, 3, 20), ("b", 4, None), ("a", 4, 1)], r=[("a", 1, 15), ("a", 2, 30), ("a", 3, 31), (None, 4, 20)])
    sides.run()
    assert sides.got() == [(1, 1), (1, 2), (2, 2), (2, 3)]
    # the watermark is 30 s less a millisecond: left rows from 20 s on and right ones from 25 s on can meet what comes
    assert sides.open() == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3)]
    sides.feed(l=[("a", 5, 36), ("a", 6, 41)], r=[("a", 5, 40), ("a", 6, 41)])
    sides.run()
    assert sides.got() == [(1, 1), (1, 2), (2, 2), (2, 3), (2, 5), (5, 3), (5, 5), (5, 6), (6, 5), (6, 6)]
    sides.run()
    assert len(sides.got()) == 10


def test_late_rows_pair_with_nothing(spark, stages):
    """The least watermark of both sides counts, and it lags by the delay."""
    sides = Sides(spark, stages, "5 seconds")
    sides.feed(l=[("a", 1, 100)], r=[("a", 1, 50)])
    sides.run()
    sides.feed(l=[("a", 2, 45), ("a", 3, 46)], r=[("a", 2, 46), ("a", 3, 101)])  # the watermark is 45 s: the first is late
    sides.run()
    assert sides.got() == [(1, 3), (3, 1), (3, 2)]


def test_pairs_of_the_state_store_join(spark, stages):
    """The same pairs as Spark's own join of streams over batches in time order with stragglers."""
    sides = Sides(spark, stages, "20 seconds")
    native = {n: sides.stream(n).withWatermark(f"{n}t", "20 seconds") for n in ("l", "r")}
    for batch in range(3):
        sides.feed(**{n: [(f"k{i % 3}", 1000 * batch + i, (batch * 60 + i * (7 if n == "l" else 11)) % (60 * batch + 61)) for i in range(40)] for n in ("l", "r")})
        sides.run()
        stages.run("native", sides.join(native["l"], native["r"]))
    want = sorted((r.lid, r.rid) for r in stages.table("native").collect())
    assert len(want) > 100 and sides.got() == want


def test_a_batch_that_is_run_again_changes_nothing(spark, stages, monkeypatch):
    """A job that dies between the pairs and the state, or between the state and the checkpoint."""
    sides, real = Sides(spark, stages), batched.write_once
    sides.feed(l=[("a", 1, 20)], r=[("a", 1, 20)])
    sides.run()
    sides.feed(l=[("a", 2, 22)], r=[("a", 2, 23)])
    for after, fails in (("/pairs", True), ("/state", True), ("none", False)):
        def once(rows, path, *more, after=after):
            done = real(rows, path, *more)
            if path.endswith(after):
                raise RuntimeError("died")
            return done

        monkeypatch.setattr(batched, "write_once", once)
        if fails:
            with pytest.raises(Exception):
                sides.run()
        else:
            sides.run()
    assert sides.got() == [(1, 1), (1, 2), (2, 1), (2, 2)]
    sides.feed(r=[("a", 3, 31)])
    sides.run()
    assert sides.got() == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3)]


def test_wide_streams_keep_no_store(spark):
    """The chain of wide orders and payments has no state store, and its tables of open rows and of what came are gone or short."""
    from rillmart.plans import catalog

    stages = catalog._stream_wide(spark, "/root/testdata/sf0.001", "payment-wide")
    root = Path(stages.folder.removeprefix("file:"))
    for topic in ("dwm_order_wide", "dwm_payment_wide"):
        assert not list(root.glob(f"checkpoints/{topic}/state*"))
        assert not list(root.glob(f"open/{topic}/new/batch=*"))
        left = spark.read.parquet(*map(str, root.glob(f"open/{topic}/state/batch=*")))
        assert left.count() <= 3  # the mark and the last rows
    assert stages.table("dwm_payment_wide").filter("order_id >= 0").count() > 0


FAVOR = "sku_id bigint, create_at timestamp"
REFUND = "order_id bigint, sku_id bigint, refund_amount decimal(16,2), create_at timestamp"


def put(spark, stages, name, schema, *rows):
    names = [c.split()[0] for c in schema.split(", ")]
    texts = spark.createDataFrame([tuple(None if v is None else str(v) for v in (*r[:-1], at(r[-1]))) for r in rows], ", ".join(f"{n} string" for n in names))
    kinds = dict(c.split() for c in schema.split(", "))
    texts.select(*[F.col(n).cast(kinds[n]).alias(n) for n in names]).coalesce(1).write.mode("append").parquet(stages.path(f"in/{name}"))


def stream(stages, name, schema):
    stages.make_folder(stages.path(f"in/{name}"))
    return stages.session.readStream.schema(schema).parquet(stages.path(f"in/{name}"))


REFUNDS = [  # (order, SKU, amount, seconds): batches with orders that come again, stragglers and late rows
    [(1, 7, 10, 5), (1, 7, 20, 9), (2, 7, 1, 25), (2, 8, 1, 25)],
    [(2, 7, 5, 21), (3, 7, 1, 22), (9, 7, 100, 9), (4, None, 2, 44), (None, 7, 3, 26)],
    [(2, 7, 1, 29), (5, 8, 4, 70)],
    [(6, 8, 8, 59), (6, 8, 8, 61), (7, 8, 1, 400)],
]


def test_sums_over_batches_are_those_of_the_state_store(spark, stages):
    """Windows that several batches add to: an order is counted once, late rows not at all, and open windows wait."""
    merged = layers.product_sources(stages, "10 seconds", {"refunds": "3 seconds"}, refunds=stream(stages, "refunds", REFUND))
    columns = ["stt", "sku_id", "refund_order_ct", "refund_amount", "ts"]
    got = lambda df: sorted(map(tuple, df.select(*columns).collect()), key=str)
    for batch, rows in enumerate(REFUNDS):
        put(spark, stages, "refunds", REFUND, *rows)
        merged.run()
        stages.run("native", stats.product_stats(stats.product_rows(refunds=stream(stages, "refunds", REFUND)), "10 seconds", "3 seconds"))
        assert got(merged.table()) == got(stages.table("native")) and merged.table().count() == (1, 3, 4, 6)[batch]
    first = [r[:4] for r in got(merged.table()) if r[1] == 7]
    assert [(r[2], float(r[3])) for r in first] == [(1, 30.0), (2, 10.0)]


def test_sums_of_a_batch_that_is_run_again(spark, stages, monkeypatch):
    """A job that dies after each thing it writes."""
    merged, real = layers.product_sources(stages, "10 seconds", {}, favor=stream(stages, "favor", FAVOR)), batched.write_once
    put(spark, stages, "favor", FAVOR, (1, 5), (1, 15))
    merged.run()
    put(spark, stages, "favor", FAVOR, (1, 16), (2, 40))
    for after in ("/new", "-parts/favor", "/state"):
        def once(rows, path, *more, after=after):
            real(rows, path, *more)
            if path.endswith(after):
                raise RuntimeError("died")

        monkeypatch.setattr(batched, "write_once", once)
        with pytest.raises(Exception):
            merged.run()
    monkeypatch.setattr(batched, "write_once", real)
    merged.beat("favor", "2021-01-01 00:00:00")
    for _ in range(2):
        merged.run()
        assert sorted((r.stt, r.sku_id, r.favor_ct) for r in merged.table().collect()) == [(at(0), 1, 1), (at(10), 1, 2), (at(40), 2, 1)]


def test_sources_of_sums_keep_no_store(spark, stages):
    """What closed windows were made of is gone; no source has a state store."""
    merged = layers.product_sources(stages, "10 seconds", {}, favor=stream(stages, "favor", FAVOR))
    put(spark, stages, "favor", FAVOR, *[(i, i) for i in range(50)])
    merged.beat("favor", "2021-01-01 00:00:00")
    merged.run()
    root = Path(stages.folder)
    assert merged.table().count() == 50 and not list(root.glob("checkpoints/*favor/state*")) and not list(root.glob("open/*/new/batch=*"))
    assert [r.mark for r in spark.read.parquet(*map(str, root.glob("open/*/state/batch=*"))).collect()] == [1609459198000]
