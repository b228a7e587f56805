"""Keyed-state operators on streams: new-flag repair, first visit of a day, bounces.

State is kept per key in RocksDB: one flag for a visitor, the key alone for a visitor's day.
Only the earliest record of a key in each Arrow batch meets it, of a visitor's day in each
micro-batch.  The state of days and of bounces, a window aggregate, passes no Python.  Within a
batch records are taken in event order.
"""

from __future__ import annotations

import sys
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefns import DAY_MILLIS, event_time
from ..operators.logs import claims_new
from ..operators.visits import WITHIN, entries

ORDER = ["ts", "event_id"]

# Functions travel to the workers as code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Bounds a window of bounces spans, besides the one that it shares with the next.
SPAN = 3


def first_claim(key, frames, state):
    """Marks the first candidate of a key; the state, one flag, never expires, as a visitor is new only once.

    Frames pass one by one: whichever of two candidates is later cannot be the
    first.  Rows that are no candidates any more pass unchanged.
    """
    seen, best = state.exists, None
    for frame in frames:
        frame = frame.copy()
        if not seen and frame["first"].any():
            open_ = frame[frame["first"]].sort_values(["ts", "event_id"])
            frame["first"] = False
            if best is None or tuple(open_.iloc[0][["ts", "event_id"]]) < tuple(best.iloc[0][["ts", "event_id"]]):
                if best is not None:
                    yield best.assign(first=False)
                best, frame = open_.iloc[:1], frame.drop(index=open_.index[0])
        else:
            frame["first"] = False
        yield frame
    if best is not None:
        state.update((True,))
        yield best


def _record(log: DataFrame):
    return F.struct(*[F.col(c) for c in log.columns]).alias("record")


def _record_type(log: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in log.schema.fields])


def _earliest(batch, keys: list[str]):
    """Which rows of Arrow data are the earliest of their keys."""
    def column(name):
        return batch.column(batch.schema.get_field_index(name))

    codes = [column(k).dictionary_encode().indices.to_numpy(zero_copy_only=False) for k in keys]
    order = np.lexsort((*[column(c).to_numpy() for c in reversed(ORDER)], *codes))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for code in codes:
        new[1:] |= code[order][1:] != code[order][:-1]
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    return pa.array(first)


def _mark_earliest(keys: list[str]):
    """Adds ``first`` to Arrow batches: whether a row is the earliest of its keys in the batch.  Records stay Arrow data."""
    def mark(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _earliest(batch, keys)], names=[*batch.schema.names, "first"])

    return mark


#: Rows a task takes in at least before it looks for the earliest again.
TAKEN_IN = 100_000


def _keep_earliest(keys: list[str]):
    """The earliest row of each key of a task, over all its Arrow batches; what is held is one row per key and what came since."""
    def cut(batches):
        whole = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        return whole.filter(_earliest(whole, keys))

    def keep(batches):
        held, came, rows = None, [], 0
        for batch in batches:
            if batch.num_rows:
                came.append(batch)
                rows += batch.num_rows
            if rows > max(TAKEN_IN, 0 if held is None else held.num_rows):
                held, came, rows = cut([*([] if held is None else [held]), *came]), [], 0
        if came:
            held = cut([*([] if held is None else [held]), *came])
        for start in range(0, 0 if held is None else held.num_rows, 10_000):
            yield held.slice(start, 10_000)

    return keep


def _marked(rows: DataFrame, keys: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return rows.mapInArrow(_mark_earliest(keys), schema.add("first", "boolean"))


def _visitor() -> list:
    """Key columns without NULL, and the places in order."""
    return [F.coalesce("common.mid", F.lit("")).alias("mid"), F.col("common.mid").isNull().alias("nameless"),
            *[F.coalesce(F.col(c), F.lit(-2 ** 63)).alias(c) for c in ORDER]]


def repair_new_flag_stream(log: DataFrame) -> DataFrame:
    """Stream form of the flag repair; records that claim nothing bypass the state.

    Within each Arrow batch of a task only the earliest claim of a visitor can be the
    first, so only these meet the visitor's state: a very busy visitor sends a row
    per batch there, and the rest of its claims are not shuffled at all.
    """
    marked = _marked(claims_new(log).select(*_visitor(), _record(log)), ["mid", "nameless"])
    text = "mid string, nameless boolean, ts bigint, event_id bigint, record string, first boolean"
    decided = marked.filter("first").withColumn("record", F.to_json("record")).groupBy("mid", "nameless").applyInPandasWithState(
        first_claim, text, "claimed boolean", "append", "NoTimeout")

    def flagged(rows: DataFrame, flag) -> DataFrame:
        return rows.withColumn("common", F.col("common").withField("is_new", flag)).select(*log.columns)

    met = decided.select(F.from_json("record", _record_type(log)).alias("r"), "first").select("r.*", "first")
    late = marked.filter(~F.col("first")).select("record.*")
    repaired = flagged(met, F.when(F.col("first"), "1").otherwise("0")).unionByName(flagged(late, F.lit("0")))
    return repaired.unionByName(log.filter(~F.col("common.is_new").eqNullSafe("1")))


def unique_visit_stream(log: DataFrame, delay: str = "24 hours") -> DataFrame:
    """Stream form of the daily unique visit: one record per (visitor, day), at once.

    The earliest entry of each visitor's day in a batch is found first, by Arrow batch and then
    by task, and meets the state as one row.  The state is the keys alone, without Python; it goes, and records
    of the day are late, when no record of the day can come any more within the delay.
    """
    day = F.floor(F.col("ts") / DAY_MILLIS)
    keys = ["mid", "nameless", "day", "ended"]
    rows = entries(log).select(*_visitor(), day.alias("day"), event_time((day + 1) * DAY_MILLIS).alias("ended"), _record(log))
    dealt = _marked(rows, keys[:3]).filter("first").drop("first").repartition(*keys[:3])
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in dealt.schema.fields])
    # The newest record's day ends up to a day after it.
    first = dealt.mapInArrow(_keep_earliest(keys[:3]), plain).withWatermark("ended", f"{delay} 1 day").dropDuplicates(keys)
    return first.select("record.*")


def unique_visit_by_day_stream(log: DataFrame, delay: str = "24 hours") -> DataFrame:
    """The same records when each day closes, as a plain aggregate: summed up before the shuffle, without Python.

    The form for consumers that read whole days; ``unique_visit_stream`` gives a
    visit at once.
    """
    timed = entries(log).withColumn("rt", event_time("ts")).withWatermark("rt", delay)
    first = timed.groupBy(F.window("rt", "1 day"), F.col("common.mid").alias("mid")).agg(
        F.min_by(_record(log), F.struct(*ORDER)).alias("record"))
    return first.select("record.*")


def entry_fates_stream(log: DataFrame, within: timedelta = WITHIN, delay: str = "2 seconds", span: int = SPAN) -> DataFrame:
    """Stream form of the entry fates, without Python and without timers.

    A visitor's records are gathered in windows of ``span`` times the bound, each
    long by one bound more, so that the next record within the bound of every entry
    of a window is in it.  The state of a key is one such window, whatever the
    backlog, and only entries hold their record; it goes, and the fates come, when
    the watermark has passed the window: at most ``span + 1`` bounds and the delay
    after the entry.
    """
    bound = within // timedelta(milliseconds=1)
    width = bound * span
    own = F.col("ts") < F.unix_millis("slice.start") + width
    opens = F.col("page.last_page_id").isNull()
    timed = log.withColumn("rt", event_time("ts")).withWatermark("rt", delay)
    seen = timed.select(
        F.window("rt", f"{width + bound} milliseconds", f"{width} milliseconds").alias("slice"), F.col("common.mid").alias("mid"), *ORDER,
        opens.alias("opens"), _record(log))
    step = F.struct(*ORDER, "opens", F.when(F.col("opens") & own, F.col("record")).alias("record"))
    visits = seen.groupBy("slice", "mid").agg(F.collect_list(step).alias("steps"))

    def fate(after):
        late = after.isNull() | (after["ts"] >= F.col("step.ts") + bound)
        return F.when(late, "timeout").when(after["opens"], "matched").otherwise("killed")

    ordered = visits.select(F.sort_array("steps").alias("steps"))
    paired = ordered.select(F.explode(F.transform("steps", lambda x, i: F.struct(
        x.alias("step"), F.get(F.col("steps"), i + 1).alias("after")))).alias("p")).select("p.*")
    entry = paired.filter(F.col("step.record").isNotNull())
    return entry.select(F.col("step.record").alias("r"), fate(F.col("after")).alias("fate")).select("r.*", "fate")


def user_jump_stream(log: DataFrame, within: timedelta = WITHIN, delay: str = "2 seconds",
                     fates: tuple[str, ...] = ("matched", "timeout")) -> DataFrame:
    return entry_fates_stream(log, within, delay).filter(F.col("fate").isin(*fates)).drop("fate")
