"""Sinks that write each batch once."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rillmart.sinks import ledger

KIND = "id long"


def ids(spark, root, name):
    return sorted(r.id for r in ledger.read_sink(spark, root, name, KIND).collect())


def test_a_batch_that_is_there_is_not_written_again(spark, tmp_path):
    path = str(tmp_path / "s")
    assert ledger.write_once(spark.range(3), path, 0)
    files = set(os.listdir(f"{path}/batch=0"))
    assert not ledger.write_once(spark.range(9), path, 0)
    assert set(os.listdir(f"{path}/batch=0")) == files and os.listdir(f"{path}/_attempts") == []


def test_an_attempt_cut_short_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    spark.range(5).write.parquet(f"{root}/s/_attempts/0-x")
    assert ids(spark, root, "s") == []
    ledger.write_once(spark.range(2), f"{root}/s", 0)
    assert ids(spark, root, "s") == [0, 1]
    stream = ledger.stream_sink(spark, root, "s", KIND)
    ledger.to_sinks(stream, {"t": lambda b: b}, root, f"{root}/c", once=True).awaitTermination()
    assert ids(spark, root, "t") == [0, 1]


def test_a_failure_between_sinks_and_a_job_behind(spark, tmp_path):
    root, given, fail = str(tmp_path), f"{tmp_path}/in", [True]
    spark.range(4).write.parquet(given)

    def odd(batch):
        if fail:
            raise RuntimeError("here")
        return batch.filter("id % 2 = 1")

    def split():
        stream = spark.readStream.schema(KIND).parquet(given)
        ledger.to_sinks(stream, {"even": lambda b: b.filter("id % 2 = 0"), "odd": odd}, root, f"{root}/c1", once=True).awaitTermination()

    def behind():
        ledger.to_sinks(ledger.stream_sink(spark, root, "even", KIND), {"double": lambda b: b.select((F.col("id") * 2).alias("id"))}, root, f"{root}/c2",
                        once=True).awaitTermination()

    with pytest.raises(StreamingQueryException):
        split()
    assert ids(spark, root, "even") == [0, 2] and ids(spark, root, "odd") == []
    behind()  # reads what the batch that failed has written already
    fail.clear()
    spark.range(4, 8).write.mode("append").parquet(given)
    split()
    behind()
    assert ids(spark, root, "even") == [0, 2, 4, 6] and ids(spark, root, "odd") == [1, 3, 5, 7] and ids(spark, root, "double") == [0, 4, 8, 12]
    entries = {(r.sink, r.batch): r.records for r in ledger.read_ledger(spark, root, ["even", "odd"]).collect()}
    assert entries == {("even", 0): 2, ("odd", 0): 2, ("even", 1): 2, ("odd", 1): 2}


def test_nothing_written_yet(spark, tmp_path):
    assert ids(spark, str(tmp_path), "s") == [] and ledger.read_ledger(spark, str(tmp_path), ["s"]).count() == 0
