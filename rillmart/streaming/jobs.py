"""Running streams over what is there and reading back what they wrote."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_folder, streaming_session
from ..sinks.ledger import read_sink, stream_sink
from ..sinks.topics import to_topic
from .batched import Side, pair_streams


class Stages:
    """A chain of streaming jobs that hand records on through Parquet topics.

    All jobs run in one sibling session with streaming settings; topics and
    checkpoints lie below one folder in shared storage.  Windows and timers the
    watermark has not passed stay open, as they would in a running job; records
    of a later time, added by ``ended``, close them.
    """

    def __init__(self, spark: SparkSession, label: str, folder: str | None = None,
                 state_partitions: int | None = None) -> None:
        self.reader = spark
        self.session = streaming_session(spark, state_partitions)
        self.folder = folder or new_folder(spark, label)
        self.schemas: dict[str, T.StructType] = {}
        self.by_batch: set[str] = set()  # topics with a folder for each batch

    def path(self, topic: str) -> str:
        return f"{self.folder}/{topic}"

    def checkpoint(self, topic: str) -> str:
        return f"{self.folder}/checkpoints/{topic}"

    def ended(self, stream: DataFrame, last: DataFrame, name: str) -> DataFrame:
        """A stream with last records of its own, which a table holds."""
        last.select(*stream.columns).write.mode("overwrite").parquet(self.path(f"{name}-end"))
        return stream.unionByName(self.session.readStream.schema(stream.schema).parquet(self.path(f"{name}-end")))

    def make_folder(self, path: str) -> None:
        """So that a stream can be planned over a folder nothing has been written to yet."""
        folder = self.session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.session._jsparkSession.sessionState().newHadoopConf()).mkdirs(folder)

    def _note(self, topic: str, rows: DataFrame) -> None:
        self.schemas[topic] = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])

    def run(self, topic: str, stream: DataFrame) -> None:
        """Take in all there is and append it to a topic."""
        self._note(topic, stream)
        to_topic(stream, self.path(topic), self.checkpoint(topic), once=True).awaitTermination()

    def run_pairs(self, topic: str, left: Side, right: Side, lower: timedelta, upper: timedelta, join: Callable[[DataFrame, DataFrame], DataFrame],
                  finish: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> None:
        """Take in all there is of two streams and append their pairs to a topic (``batched.pair_streams``)."""
        self._note(topic, finish(join(*[self.session.createDataFrame([], side.rows.schema) for side in (left, right)])))
        self.by_batch.add(topic)
        pair_streams(left, right, lower, upper, join, finish, self.path(topic), self.path(f"open/{topic}"), self.checkpoint(topic),
                     once=True).awaitTermination()

    def stream(self, topic: str) -> DataFrame:
        """A finished stage's topic as the input of the next."""
        if topic in self.by_batch:
            return stream_sink(self.session, self.folder, topic, self.schemas[topic])
        return self.session.readStream.schema(self.schemas[topic]).parquet(self.path(topic))

    def table(self, topic: str) -> DataFrame:
        """What a stage wrote, as a table."""
        if topic in self.by_batch:
            return read_sink(self.reader, self.folder, topic, self.schemas[topic])
        return self.reader.read.schema(self.schemas[topic]).parquet(self.path(topic))


class Replay:
    """Tables dealt into parts by time and fed one part after another, as topics that grow."""

    def __init__(self, stages: Stages, parts: int) -> None:
        self.stages, self.parts, self.fed = stages, parts, 0
        self.tables: list[tuple[str, DataFrame, Column, DataFrame | None]] = []

    def cuts(self, df: DataFrame, time: str) -> list:
        """Times that cut a table's span into parts of equal length."""
        low, high = df.agg(F.min(time), F.max(time)).first()
        return [] if low is None else [low + (high - low) * k / self.parts for k in range(1, self.parts)]

    def add(self, name: str, df: DataFrame, time: str, cuts: list, end: DataFrame | None = None) -> DataFrame:
        """The stream of a table; ``end`` holds rows that come with the last part."""
        part = sum([F.coalesce(F.col(time) >= F.lit(c), F.lit(False)).cast("int") for c in cuts], F.lit(0))
        self.tables.append((name, df, part, None if end is None else end.select(*df.columns)))
        path = self.stages.path(f"in/{name}")
        self.stages.make_folder(path)
        return self.stages.session.readStream.schema(df.schema).parquet(path)

    def feed(self) -> bool:
        """Write the next part of every table; false when there is none."""
        if self.fed == self.parts:
            return False
        for name, df, part, end in self.tables:
            rows = df.filter(part == self.fed)
            if end is not None and self.fed + 1 == self.parts:
                rows = rows.unionByName(end)
            rows.write.mode("append").parquet(self.stages.path(f"in/{name}"))
        self.fed += 1
        return True
