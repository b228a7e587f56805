"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName("rillmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """A session whose zone is UTC, in which all event times of this library are read.

    The caller's session is left as it is: with another zone a sibling session
    with the caller's other settings is returned.
    """
    if spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return spark
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    return sibling


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only on one machine, and only where none is named, is a folder made here; a
    cluster has to name one.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="rillmart-")
    return _local_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder, one per run."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session (same cluster, own settings) for stateful streams.

    The number of state partitions is frozen into a checkpoint when a query
    first starts, so it is chosen here and not left to the batch default.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # A commit uploads what changed, not the whole store.
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Counting the rows of a store costs a read before every write.
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return sibling
