"""Dimension tables dealt into hash buckets: a batch of changes reads and rewrites only the buckets its keys fall into.

For tables whose batches change few keys beside what they hold; ``dims`` appends changes instead and joins
the whole base on every read.  The number of buckets is chosen when the table is made and kept in
its state; a bucket should hold what one task writes well, some hundred megabytes.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import PRESENT, merge_changes
from .parts import PART, State, newest_state, read_parts, replace_parts
from .topics import start

#: The batch number of the table as it was made.
MADE = -1


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key, by its text, so that a number and its digits fall into the same one."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))


def _settings(state: State) -> tuple[str, int]:
    kept = json.loads(state.note)
    return kept["key"], kept["buckets"]


def _state(spark: SparkSession, path: str) -> State:
    state = newest_state(spark, path)
    if state is None:
        raise FileNotFoundError(f"no bucketed table at {path}")
    return state


def make_table(base: DataFrame, path: str, key: str, buckets: int) -> bool:
    """Deal a table with a row per key into buckets unless it is there already; says whether it was made."""
    if newest_state(base.sparkSession, path) is not None:
        return False
    rows = base.withColumn(PART, bucket_of(key, buckets)).repartition(buckets, PART)
    replace_parts(base.sparkSession, path, MADE, range(buckets), lambda _: rows, json.dumps({"key": key, "buckets": buckets}))
    return True


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, _state(spark, path)).drop(PART)


def read_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The rows of the keys that a table ``keys`` holds in the key's column, read from their buckets alone."""
    state = _state(spark, path)
    key, buckets = _settings(state)
    wanted = keys.select(F.col(key).cast(state.columns[key].dataType).alias(key)).distinct()
    return read_parts(spark, path, state, _touched(wanted, key, buckets)).drop(PART).join(wanted, key, "left_semi")


def _touched(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """At most one number per bucket."""
    return [r.part for r in rows.select(bucket_of(key, buckets).alias(PART)).distinct().toLocalIterator()]


def apply_changes(changes: DataFrame, path: str, batch_id: int, order_by: str) -> State:
    """Upsert one batch: the newest value of each column its changes set, column by column; other keys keep their rows.

    ``_present`` names the columns a change sets, all of them where it is missing; columns the table does not know yet are added, NULL in the rows
    that are there.  Changes without a key are left out.  The buckets of the changed keys and the changes meet in one exchange by bucket, in
    which a hot key is summed up before.
    """
    spark = changes.sparkSession
    key, buckets = _settings(_state(spark, path))
    changes = changes.filter(F.col(key).isNotNull())
    columns = [c for c in changes.columns if c not in (key, order_by, PRESENT)]
    if PRESENT not in changes.columns:
        changes = changes.withColumn(PRESENT, F.array(*[F.lit(c) for c in columns]))
    touched = _touched(changes, key, buckets)

    def build(before: State) -> DataFrame:
        kinds = {f.name: f.dataType for f in before.columns}
        fresh = merge_changes(changes.withColumn(key, F.col(key).cast(kinds[key])), key, order_by).withColumn(PART, bucket_of(key, buckets))
        names = [*kinds, *[c for c in columns if c not in kinds]]
        rest = [c for c in names if c != key]
        types = {c: kinds.get(c, fresh.schema[c].dataType if c in fresh.columns else None) for c in rest}
        old = read_parts(spark, path, before, touched)

        def side(rows: DataFrame, new: bool) -> DataFrame:
            """Each value with whether it is new; NULL where the side does not set it."""
            def value(c: str) -> Column:
                if c not in rows.columns:
                    sets = F.lit(False)
                else:
                    sets = F.array_contains(PRESENT, c) if new else F.lit(True)
                held = F.col(c).cast(types[c]) if c in rows.columns else F.lit(None).cast(types[c])
                return F.when(sets, F.struct(F.lit(new).alias("new"), held.alias("v"))).alias(c)

            return rows.select(PART, key, *[value(c) for c in rest])

        both = side(old, False).unionByName(side(fresh, True)).repartition(max(len(touched), 1), PART)
        merged = both.groupBy(PART, key).agg(*[F.max(c).alias(c) for c in rest])
        return merged.select(*[F.col(c)["v"].alias(c) if c != key else F.col(key) for c in names], PART)

    return replace_parts(spark, path, batch_id, touched, build, json.dumps({"key": key, "buckets": buckets}))


def stream_changes(changes: DataFrame, path: str, order_by: str, checkpoint: str, **run) -> StreamingQuery:
    """Upsert a stream of changes batch by batch into a table that is there; a repeated batch changes nothing more."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            apply_changes(batch, path, batch_id, order_by)
        finally:
            batch.unpersist()

    return start(changes.writeStream.foreachBatch(write), checkpoint, **run)
