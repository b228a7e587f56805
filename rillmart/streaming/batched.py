"""Joins and windowed sums of streams by batch plans, with Parquet tables for state.

A state store takes each row for itself, so a batch of very many rows costs some 50 microseconds of a core and a few
hundred bytes of disk a row before anything is joined.  Here the rows of a batch are put down once, an ordinary plan, which
sorts, merges and spills, joins or sums them with what earlier batches left open, and what is open after the batch is
the state of the next one.

Watermarks are those of Spark: the latest time of each side less its delay, the least of all sides, never going back
and beginning with the epoch.  What is behind the watermark when it comes is late and left out.

A batch shows in its topic whole, by renaming (``ledger``); its state is written after that, so a batch that is run again
writes only what is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timefns import interval
from ..sinks.dims import complete
from ..sinks.kept import PARTITION_BYTES, file_system
from ..sinks.ledger import write_once
from ..sinks.stats import with_dt
from ..sinks.topics import start

#: Partitions of a shuffle for each task that reads a batch, whose size is not known before.
PER_INPUT = 4


@contextmanager
def partitions_for(spark: SparkSession, *paths: str, least: int = 1) -> Iterator[None]:
    """As many shuffle partitions as the files below the paths ask for, ``least`` at least; adaptive plans put small ones together."""
    adaptive, partitions = "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"
    before = {key: spark.conf.get(key) for key in (adaptive, partitions)}
    found = (file_system(spark, path) for path in paths)
    needed = -(-sum(fs.getContentSummary(path).getLength() for path, fs in found) // PARTITION_BYTES)
    spark.conf.set(adaptive, "true")
    spark.conf.set(partitions, str(max(int(before[partitions]), needed, least)))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _millis(spark: SparkSession, delay: str) -> int:
    return spark.sql(f"select unix_millis(timestamp_millis(0) + interval {delay})").first()[0]


class _Work:
    """What one batch puts down and finds: ``fresh`` rows, and the state after the batch before."""

    def __init__(self, batch: DataFrame, batch_id: int, root: str, sides: int) -> None:
        self.spark, self.id = batch.sparkSession, batch_id
        self.states, self.new = f"{root}/state", f"{root}/new"
        finished = complete(self.spark, self.states, "batch")
        self.done = batch_id in finished
        self.before = max((n for n in finished if n < batch_id), default=None)
        self.mark, self.lasts = 0, [None] * sides
        if self.before is not None and not self.done:
            self.mark, self.lasts = self._read(self.states, self.before).filter("mark is not null").select("mark", "lasts").first()

    def _read(self, path: str, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{path}/batch={number}")

    def paths(self) -> list[str]:
        return [f"{self.new}/batch={self.id}", *([] if self.before is None else [f"{self.states}/batch={self.before}"])]

    def put_down(self, rows: DataFrame) -> DataFrame:
        write_once(rows, self.new, self.id)
        return self._read(self.new, self.id)

    def open(self) -> DataFrame | None:
        """Rows the batches before left open."""
        return None if self.before is None else self._read(self.states, self.before).filter("mark is null").drop("mark", "lasts")

    def move_on(self, seen: dict[int, int], delays: list[int]) -> int:
        """The watermark after the batch, from the latest milliseconds of each side."""
        self.lasts = [max((x for x in (last, seen.get(n)) if x is not None), default=None) for n, last in enumerate(self.lasts)]
        self.mark = max(self.mark, min(0 if last is None else last - delay for last, delay in zip(self.lasts, delays, strict=True)))
        return self.mark

    def leave(self, rows: DataFrame) -> None:
        """Write the state after the batch; what it was made from goes."""
        lasts = F.array(*[F.lit(last).cast("bigint") for last in self.lasts])
        mark = self.spark.range(0, 1, 1, 1).select(F.lit(self.mark).cast("bigint").alias("mark"), lasts.alias("lasts"))
        write_once(rows.unionByName(mark, allowMissingColumns=True), self.states, self.id)
        self.clear()

    def clear(self) -> None:
        for path in (f"{self.new}/batch={self.id}", *(f"{self.states}/batch={n}" for n in complete(self.spark, self.states, "batch") if n < self.id)):
            path, fs = file_system(self.spark, path)
            fs.delete(path, True)


def _at(millis: int) -> Column:
    return F.timestamp_millis(F.lit(millis))


@dataclass
class Side:
    """One side of a join: a stream, its event time and how far it is out of order."""

    rows: DataFrame
    time: Column
    delay: str


def pair_streams(left: Side, right: Side, lower: timedelta, upper: timedelta, join: Callable[[DataFrame, DataFrame], DataFrame],
                 finish: Callable[[DataFrame], DataFrame], path: str, root: str, checkpoint: str, **run) -> StreamingQuery:
    """Pairs of two streams whose right time lies in ``[left + lower, left + upper]``, to ``<path>/batch=<n>``.

    ``join`` makes the pairs of two tables within these bounds, ``finish`` adds what hangs on a pair.  Each pair comes with the later of its rows.
    A left row stays open while a right row not behind the watermark can be near enough, and the other way round.
    """
    sides = {"l": left, "r": right}

    def tagged(name: str, number: int) -> DataFrame:
        held = [F.struct(*s.rows.columns).alias(n) if n == name else F.lit(None).cast(s.rows.schema).alias(n) for n, s in sides.items()]
        return sides[name].rows.select(F.lit(number).alias("_side"), sides[name].time.alias("_time"), *held)

    def write(batch: DataFrame, batch_id: int) -> None:
        work = _Work(batch, batch_id, root, 2)
        if work.done:
            return work.clear()
        spark = work.spark
        came, late = work.put_down(batch.filter(F.col("_time") > _at(work.mark))), work.open()
        last_left = work.lasts[0]
        parts = {(n, when): rows.filter(F.col("_side") == number) for number, n in enumerate(sides)
                 for when, rows in (("new", came), ("old", late)) if rows is not None}
        rows_of = lambda df, n: df.select(f"{n}.*")
        with partitions_for(spark, *work.paths()):
            all_right = [rows_of(parts["r", when], "r") for when in ("new", "old") if ("r", when) in parts]
            pairs = join(rows_of(parts["l", "new"], "l"), reduce(DataFrame.unionByName, all_right))
            if late is not None and last_left is not None:
                near = F.col("_time") <= _at(last_left + 1) + interval(upper)
                pairs = pairs.unionByName(join(rows_of(parts["l", "old"], "l"), rows_of(parts["r", "new"].filter(near), "r")))
            write_once(finish(pairs), path, batch_id)
            seen = {r[0]: r[1] for r in came.groupBy("_side").agg(F.unix_millis(F.max("_time"))).collect()}  # a row per side
            mark, time = _at(work.move_on(seen, [_millis(spark, s.delay) for s in sides.values()])), F.col("_time")
            open_rows = came if late is None else came.unionByName(late)
            work.leave(open_rows.filter(((F.col("_side") == 0) & (time >= mark - interval(upper))) | ((F.col("_side") == 1) & (time >= mark + interval(lower)))))

    both = tagged("l", 0).unionByName(tagged("r", 1))
    return start(both.writeStream.foreachBatch(write), checkpoint, **run)


@dataclass
class WindowSums:
    """Sums by window in two steps.  ``first`` sums rows with event time ``rt`` by ``window``, further keys and those it is given,
    with the latest ``rt`` as ``last``; ``again`` sums such sums; ``close`` makes of them the statistics of closed windows, with ``stt``."""

    first: Callable[..., DataFrame]
    again: Callable[[DataFrame], DataFrame]
    close: Callable[[DataFrame], DataFrame]


def sum_windows(rows: DataFrame, sums: WindowSums, delay: str, path: str, root: str, checkpoint: str, **run) -> StreamingQuery:
    """Statistics of the windows that the watermark has passed, by day of their start, to ``<path>/batch=<n>/dt=<day>``.

    Rows marked ``_beat`` move the watermark and count for nothing else.  A window whose end is behind the watermark is late.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        work = _Work(batch, batch_id, root, 1)
        if work.done:
            return work.clear()
        spark, end = work.spark, F.col("window.end")
        with partitions_for(spark, least=PER_INPUT * batch._jdf.queryExecution().toRdd().getNumPartitions()):
            came = work.put_down(sums.first(batch, "_beat").filter(end > _at(work.mark)))
        late = work.open()
        seen = came.agg(F.unix_millis(F.max("last"))).first()[0]
        mark = _at(work.move_on({} if seen is None else {0: seen}, [_millis(spark, delay)]))
        with partitions_for(spark, *work.paths()):
            held = came.filter(~F.col("_beat")).drop("_beat")
            held = held if late is None else sums.again(held.unionByName(late))
            write_once(with_dt(sums.close(held.filter(end <= mark))).hint("rebalance", "dt"), path, batch_id, "dt")
            work.leave(held.filter(end > mark))

    return start(rows.writeStream.foreachBatch(write), checkpoint, **run)
