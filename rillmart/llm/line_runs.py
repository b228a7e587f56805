"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches of ascending doc_id.  The runs hold the hash of every line
key seen so far, each once, as tables bucketed and sorted by hash.  A new batch is
reduced to (key, smallest doc_id), merge-anti-joined to each run, and what is left
becomes a run of its own; runs of one level are compacted into one of the next.
Buckets of the runs are not shuffled again by later batches.  All of it is
DataFrame functions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from .common import buckets_for, let, stored

#: Shorter keys are never dropped.
LEAST_KEY = 10
#: Batches a whole table is dealt into, and runs of one level that are compacted into one.
BATCHES = 4
FANOUT = 2
#: Stands for a NULL doc_id: after all others.
LAST_ID = 2 ** 63 - 1

_WHITE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A to Z in lower case."""
    bare = F.btrim(line, F.lit(_WHITE))
    # Lower case of plain ASCII changes A to Z alone, and is much the faster way.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _row_hash(text: Column, doc_id: Column) -> Column:
    return F.xxhash64(doc_id, text)


class LineRuns:
    """Levelled runs: ``levels[k]`` lists the tables of level k, oldest first."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark, self.fanout, self.buckets = spark, fanout, buckets or buckets_for(spark)
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, *_HASH).write.format("parquet").option("path", new_folder(self.spark, "line-run"))
         .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(name))
        return name

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (with columns h1 and h2) whose key no run holds."""
        for name in self.names():
            keys = keys.join(self.spark.table(name).select(*_HASH).hint("merge"), _HASH, "left_anti")
        return keys

    def add(self, entries: DataFrame) -> DataFrame:
        """Take in a batch of (h1, h2, id); returns its new keys with ``first``, the smallest id that holds each."""
        firsts = entries.groupBy(*_HASH).agg(F.min("id").alias("first"))
        name = self._write(self.unseen(firsts))
        self._push(0, name)
        return self.spark.table(name)

    def _push(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            # Their keys are disjoint: one sorted run of all of them.
            parts = [self.spark.table(n) for n in self.levels[level]]
            self.levels[level] = []
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionAll(part)
            self._push(level + 1, self._write(whole))


def line_entries(docs: DataFrame) -> DataFrame:
    """(id, row, pos, h1, h2) of every line whose key is long enough; ``row`` tells rows of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), _row_hash(F.col("text"), F.col("doc_id")).alias("row"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    long = lines.filter(F.char_length(F.btrim("line", F.lit(_WHITE))) >= LEAST_KEY)
    key = line_key(F.col("line"))
    return long.select("id", "row", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def dropped_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(id, row, gone): per document the numbers of the lines that a smaller doc_id holds, where there are any."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [k / batches for k in range(1, batches)], 10_000)).first()[0]
    batch = sum([(F.col("id") > c).cast("int") for c in sorted(set(cuts or []))], F.lit(0))
    path = new_folder(spark, "line-entries")
    entries = line_entries(docs).withColumn("batch", batch)
    entries.write.partitionBy("batch").parquet(path)
    entries = spark.read.schema(entries.schema).parquet(path)
    runs = LineRuns(spark, fanout)
    gone = None
    for k in range(len(set(cuts or [])) + 1):
        part = entries.filter(F.col("batch") == k).drop("batch")
        new = runs.add(part.select("id", *_HASH)).withColumnRenamed("first", "id")
        # A line stays where its key is new and this document is the first to hold it.
        again = part.join(new.hint("merge"), [*_HASH, "id"], "left_anti").select("id", "row", "pos")
        gone = again if gone is None else gone.unionAll(again)
    return stored(gone.groupBy("id", "row").agg(F.collect_set("pos").alias("gone")), "dropped-lines")


def _joined(docs: DataFrame) -> DataFrame:
    """(doc, gone): each row as a struct, and its dropped line numbers or NULL."""
    gone = dropped_lines(docs.select("doc_id", "text"))
    doc_id = F.col("doc.doc_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.select("doc", F.coalesce(doc_id.cast("long"), F.lit(LAST_ID)).alias("id"), _row_hash(F.col("doc.text"), doc_id).alias("row"))
    return rows.join(gone, ["id", "row"], "left").select("doc", "gone")


def _kept(text: Column, gone: Column) -> Column:
    def left(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.concat_ws("\n", F.transform(numbers, lambda i: F.get(lines, i)))

    return F.when(gone.isNull(), text).otherwise(let(F.split(text, "\n"), left))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines whose key a document of smaller doc_id holds; n_chars follows the text.

    A NULL text stays NULL; it and an empty text have one empty line.  Keys under ten
    code points stay.  Repeats of a line inside the first document that holds it stay.
    Rows of one doc_id are one document and keep what it keeps; rows without a doc_id
    are one document after all others.  Two keys are one when 128 bits of their hashes
    are.  An empty table gives an empty table; other columns are handed on as they are.
    """
    text = F.col("doc.text")
    kept = _kept(text, F.col("gone"))
    size = F.when(F.col("gone").isNull(), F.col("doc.n_chars")).otherwise(F.length(kept)) if "n_chars" in docs.columns else None
    new = {"text": kept} if size is None else {"text": kept, "n_chars": size.cast(docs.schema["n_chars"].dataType)}
    return _joined(docs).select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """The digest of the query: doc_id, n_lines, n_dropped and the SHA-256 of the kept lines."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    return _joined(docs.select("doc_id", "text")).select(
        "doc.doc_id", F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept(text, F.col("gone")), 256).alias("kept_sha256"))
