"""Dimension tables as Parquet folders in shared storage.

A table is a folder with ``base/v=<n>`` (the state up to batch ``n``) and
``changes/batch=<m>`` (rows changed by batch ``m``, with the columns each sets).  A batch costs what it
changes, not what the table holds; ``compact`` folds the changes into a new base
while readers go on with the old one.  Folders count once their ``_SUCCESS``
mark is there, so a batch cut short is not seen and a repeated one replaces its
own folder.  Readers see the newest state each time they call ``read_dim``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.routing import TO_DIM, dim_changes
from ..operators.upsert import PRESENT, merge_changes, upsert
from .topics import start

SEQ = "_seq"
DEFAULT_KEY = "id"
#: Batches of changes after which a table is folded into a new base.
COMPACT_AFTER = 50


def dim_schema(columns: str, key: str | None = None) -> T.StructType:
    """All-text schema from a comma-separated column list; the key comes first if it is not listed."""
    names = [c.strip() for c in columns.split(",") if c.strip()]
    pk = key or DEFAULT_KEY
    if pk not in names:
        names.insert(0, pk)
    return T.StructType([T.StructField(n, T.StringType(), n != pk) for n in names])


def complete(spark: SparkSession, folder: str, part: str) -> list[int]:
    """Numbers of the finished subfolders ``<part>=<n>``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}=*/_SUCCESS")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(path) or []
    return sorted(int(s.getPath().getParent().getName().split("=", 1)[1]) for s in found)


def create_dim(spark: SparkSession, path: str, columns: str, key: str | None = None) -> bool:
    """Make an empty table unless there is one; says whether it was made."""
    if complete(spark, f"{path}/base", "v"):
        return False
    spark.createDataFrame([], dim_schema(columns, key)).write.mode("overwrite").parquet(f"{path}/base/v=-1")
    return True


def config_tables(config: DataFrame) -> dict[str, tuple[str, str | None]]:
    """{dimension table: (its columns, key)} of a routing config, a short table.

    Operations may list different columns of one table; it has the columns of all.
    """
    tables: dict[str, tuple[list[str], str | None]] = {}
    rows = config.filter(F.col("sinkType") == TO_DIM).select("sinkTable", "sinkColumns", "sinkPk").distinct()
    for r in sorted(rows.toLocalIterator(), key=lambda r: (r.sinkTable, len(r.sinkColumns or ""), r.sinkColumns or "")):
        columns, key = tables.get(r.sinkTable, ([], None))
        listed = [c.strip() for c in (r.sinkColumns or "").split(",")]
        tables[r.sinkTable] = (columns + [c for c in listed if c and c not in columns], key or r.sinkPk)
    return {t: (",".join(columns), key) for t, (columns, key) in tables.items()}


def create_from_config(spark: SparkSession, root: str, config: DataFrame) -> list[str]:
    """Create the dimension tables a routing config names; says which were made."""
    return sorted(t for t, (columns, key) in config_tables(config).items() if create_dim(spark, f"{root}/{t}", columns, key))


def changed_columns(rows: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Changes with a map ``after`` as text columns and the names of those the map holds."""
    names = F.array(*[F.lit(c) for c in columns])
    return rows.select(*[F.col("after")[c].alias(c) for c in columns], F.array_intersect(F.map_keys("after"), names).alias(PRESENT), *keep)


def append_changes(changes: DataFrame, path: str, batch_id: int, key: str, order_by: str) -> None:
    """Write one batch, a row per key: the newest value of each column its changes set.

    Without a column ``_present`` every change sets all its columns.
    """
    if PRESENT not in changes.columns:
        columns = [c for c in changes.columns if c not in (key, order_by)]
        changes = changes.withColumn(PRESENT, F.array(*[F.lit(c) for c in columns]))
    rows = merge_changes(changes, key, order_by)
    texts = [c for c in rows.columns if c not in (order_by, PRESENT)]
    rows.select(*[F.col(c).cast("string").alias(c) for c in texts], PRESENT).write.mode("overwrite").parquet(
        f"{path}/changes/batch={batch_id}")


def read_dim(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The present state: the newest base with all later batches applied, columns added later included."""
    versions = complete(spark, f"{path}/base", "v")
    if not versions:
        raise FileNotFoundError(f"no dimension table at {path}")
    base = spark.read.parquet(f"{path}/base/v={versions[-1]}")
    later = [b for b in complete(spark, f"{path}/changes", "batch") if b > versions[-1]]
    if not later:
        return base
    folders = [f"{path}/changes/batch={b}" for b in later]
    reader = spark.read.option("basePath", f"{path}/changes").option("mergeSchema", "true")
    return upsert(base, reader.parquet(*folders).withColumnRenamed("batch", SEQ), key, SEQ, PRESENT)


def compact(spark: SparkSession, path: str, key: str) -> int:
    """Fold all finished batches into a new base and return its number.

    What the base before it no longer needs is removed; that base and its changes
    stay for readers that have just opened them.
    """
    batches = complete(spark, f"{path}/changes", "batch")
    versions = complete(spark, f"{path}/base", "v")
    target = max([*batches, *versions])
    if target not in versions:
        read_dim(spark, path, key).write.mode("overwrite").parquet(f"{path}/base/v={target}")
        before = versions[-1]
        _remove(spark, [f"{path}/base/v={v}" for v in versions if v < before] + [f"{path}/changes/batch={b}" for b in batches if b <= before])
    return target


def _remove(spark: SparkSession, folders: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def write_batch(routed: DataFrame, root: str, tables: dict[str, tuple[list[str], str]], batch_id: int, order_by: str,
                compact_after: int) -> None:
    """Append one batch of routed changes to the tables it has rows for; fold a table's changes when there are many."""
    rows = dim_changes(routed)
    touched = {r.sinkTable for r in rows.select("sinkTable").distinct().toLocalIterator()}
    for table in sorted(touched & tables.keys()):
        columns, key = tables[table]
        append_changes(changed_columns(rows.filter(F.col("sinkTable") == table), columns, (order_by,)), f"{root}/{table}", batch_id, key, order_by)
        if len(complete(routed.sparkSession, f"{root}/{table}/changes", "batch")) >= compact_after:
            compact(routed.sparkSession, f"{root}/{table}", key)


def stream_dims(routed: DataFrame, root: str, tables: dict[str, tuple[list[str], str]], checkpoint: str,
                order_by: str, compact_after: int = COMPACT_AFTER, **run) -> StreamingQuery:
    """Upsert a stream of routed changes into its dimension tables, ``{table: (columns, key)}``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch, root, tables, batch_id, order_by, compact_after)
        finally:
            batch.unpersist()

    return start(routed.writeStream.foreachBatch(write), checkpoint, **run)
