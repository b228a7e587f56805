"""Windowed statistics of several sources, each under a watermark of its own.

In one query over a union the slowest source holds the windows of all, and one that
is years ahead of the others makes them late.  Here every source is a query with its
own watermark and delay that appends partial sums of the windows it closes (``batched.sum_windows``).  A merge
adds the partial sums up, day by day: what a batch of them touches is summed anew from
the stored parts and replaced, so a batch that is run again changes nothing.

A source that falls silent holds nobody.  Its own last windows close by a beat, a time
that its producer promises to have passed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.stats import save_stats
from ..sinks.topics import start
from .batched import WindowSums, partitions_for, sum_windows
from .jobs import Stages

DAY, BATCH = "dt", "batch"
#: Sources that run side by side; each is several stages of its own, whose plans the driver holds.
AT_ONCE = 2


class MergedSources:
    """``sums`` turns the rows of a source, with event time ``rt``, into partial statistics with a window
    start ``stt``; ``merge`` adds up partial statistics of all sources."""

    def __init__(self, stages: Stages, name: str, sums: WindowSums, merge: Callable[[DataFrame], DataFrame]) -> None:
        self.stages, self.name, self.sums, self.merge = stages, name, sums, merge
        self.parts: dict[str, tuple[DataFrame, str]] = {}

    def _parts_path(self, source: str) -> str:
        return self.stages.path(f"{self.name}-parts/{source}")

    def _beats_path(self, source: str) -> str:
        return self.stages.path(f"{self.name}-beats/{source}")

    def add(self, source: str, rows: DataFrame, delay: str) -> None:
        """A stream of rows with event time ``rt``, at most ``delay`` out of order."""
        self.stages.make_folder(self._beats_path(source))
        beats = self.stages.session.readStream.schema("rt timestamp").parquet(self._beats_path(source))
        beats = beats.select(*[F.col("rt") if f.name == "rt" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
        self.parts[source] = rows.withColumn("_beat", F.lit(False)).unionByName(beats.withColumn("_beat", F.lit(True))), delay

    def beat(self, source: str, time: str) -> None:
        """Nothing of this source is older than ``time`` any more."""
        self.stages.session.range(1).select(F.lit(time).cast("timestamp").alias("rt")).write.mode("append").parquet(self._beats_path(source))

    def run(self) -> None:
        """One round: all sources, a few side by side, take in what there is, then the merge."""
        running = []
        for source, (rows, delay) in self.parts.items():
            if len(running) == AT_ONCE:
                running.pop(0).awaitTermination()
            running.append(sum_windows(rows, self.sums, delay, self._parts_path(source), self.stages.path(f"open/{self.name}-{source}"),
                                       self.stages.checkpoint(f"{self.name}-{source}"), once=True))
        for query in running:
            query.awaitTermination()
        self._merge()

    def _schema(self, source: str) -> T.StructType:
        rows = self.stages.session.createDataFrame([], self.parts[source][0].schema)
        made = self.sums.close(self.sums.first(rows)).schema.fields
        return T.StructType([*[T.StructField(f.name, f.dataType) for f in made], T.StructField(BATCH, T.IntegerType()), T.StructField(DAY, T.IntegerType())])

    def _merge(self) -> None:
        s, schemas = self.stages.session, {source: self._schema(source) for source in self.parts}

        def stored(reader) -> DataFrame:
            return reduce(DataFrame.unionByName, [reader.schema(schemas[source]).parquet(self._parts_path(source)) for source in self.parts])

        def write(batch: DataFrame, batch_id: int) -> None:
            # Days of the calendar, not groups of the data.
            days = [r[0] for r in batch.select(DAY).distinct().toLocalIterator()]
            if days:
                spark = batch.sparkSession
                with partitions_for(spark, *map(self._parts_path, self.parts)):
                    whole = self.merge(stored(spark.read).filter(F.col(DAY).isin(days)).drop(BATCH, DAY))
                    save_stats(whole, self.stages.path(self.name), whole.columns, "overwrite", partitionOverwriteMode="dynamic")

        for source in self.parts:
            self.stages.make_folder(self._parts_path(source))
        start(stored(s.readStream).select(DAY).writeStream.foreachBatch(write), self.stages.checkpoint(f"{self.name}-merge"),
              once=True).awaitTermination()

    def table(self) -> DataFrame:
        """What is merged so far; the day is the partition ``dt``."""
        first = next(iter(self.parts))
        empty = self.stages.reader.createDataFrame([], self._schema(first))
        self.stages.make_folder(self.stages.path(self.name))
        schema = T.StructType([*self.merge(empty.drop(BATCH, DAY)).schema.fields, T.StructField(DAY, T.IntegerType())])
        return self.stages.reader.read.schema(schema).parquet(self.stages.path(self.name))
