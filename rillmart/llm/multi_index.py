"""Approximate nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised alone; a pair of centroids is a cell.  A query
visits cells by the summed inner products of its halves with the centroids, best first
from a heap, until they hold enough vectors, and all vectors of those cells are ranked
by their exact inner product.  How many vectors are enough is read off the sample the
centroids are fitted on: the share that reaches RECALL there.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, stored

#: Vectors the index is fitted on at most, chosen by a hash of their id, and queries among them.
MOST_SAMPLE = 20_000
SAMPLE_QUERIES = 300
MOST_CENTROIDS = 64
ROUNDS = 12
RECALL = 0.96
#: Vectors of a shard, and of a part of a cell; larger cells are split.
SHARD_ROWS = 2_000
#: Queries a task ranks at once.
QUERY_BLOCK = 256


def _centroids(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    rng = np.random.default_rng(11)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=k)
        c[count > 0] = sums[count > 0] / count[count > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c ** 2).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)


@dataclass
class MultiIndex:
    """Centroids of both halves, and the share of all vectors a query looks at."""

    first: np.ndarray
    second: np.ndarray
    share: float = 1.0

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def cell(self, x: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return _nearest(x[:, :half], self.first) * len(self.second) + _nearest(x[:, half:], self.second)

    def visit(self, query: np.ndarray, counts: list[int], enough: float) -> list[int]:
        """Cells by descending summed inner product until they hold ``enough`` vectors; empty cells are left out."""
        half, width = self.first.shape[1], len(self.second)
        a, b = self.first @ query[:half], self.second @ query[half:]
        row, col = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        a, b = (-a[row]).tolist(), (-b[col]).tolist()
        heap, found, out = [(a[0] + b[0], 0, 0)], 0, []
        while heap and found < enough:
            _, i, j = heap[0]
            if j + 1 < width:
                heapq.heapreplace(heap, (a[i] + b[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
            if not j and i + 1 < len(row):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
            cell = row[i] * width + col[j]
            if counts[cell]:
                found += counts[cell]
                out.append(cell)
        return out


def fit(sample: np.ndarray, neighbours: int, most_centroids: int = MOST_CENTROIDS, recall: float = RECALL) -> MultiIndex:
    """Centroids of a sample, and the share of vectors at which its own queries find ``recall`` of their neighbours."""
    k = max(1, min(most_centroids, int(len(sample) ** 0.5 / 2)))
    half = max(1, sample.shape[1] // 2)
    index = MultiIndex(_centroids(sample[:, :half], k), _centroids(sample[:, half:], k))
    cell = index.cell(sample)
    counts = np.bincount(cell, minlength=index.cells)
    needed = []
    for q in np.random.default_rng(12).choice(len(sample), min(len(sample), SAMPLE_QUERIES), replace=False):
        score = sample @ sample[q]
        score[q] = -np.inf
        best = np.argpartition(-score, min(neighbours, len(score) - 1))[:neighbours]
        order = index.visit(sample[q], counts.tolist(), np.inf)
        reach = np.zeros(index.cells)
        reach[order] = np.cumsum(counts[order])
        needed.append(reach[cell[best[best != q]]])
    needed = np.concatenate(needed) if needed else np.zeros(0)
    if len(needed):
        index.share = float(min(1.0, np.quantile(needed, recall) / len(sample)))
    return index


def usable(embedding: Column) -> Column:
    """Neither NULL nor empty nor zero, and every component a finite number."""
    return F.coalesce(F.forall(embedding, lambda e: F.coalesce((F.abs(e) < math.inf) & ~F.isnan(e), F.lit(False)))
                      & F.exists(embedding, lambda e: e != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(np.float64)


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: usable, with an id, of the most frequent length.

    A repeated id counts once, with its smallest vector.
    """
    rows = embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("embedding") == (size[0]["n"] if size else 0))


def _floor(scores: np.ndarray, n: int) -> np.ndarray:
    """What the ``n``-th best of each row reaches, less a margin for rounding; minus infinity where there are fewer."""
    if scores.shape[1] < n:
        return np.full(len(scores), -np.inf)
    least = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
    return np.where(np.isfinite(least), least - 1e-9 * np.maximum(1.0, np.abs(least)), -np.inf)


def _best(query_ids, queries, probed, floor, ids, vectors, cells, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The ``n`` best of these vectors (ascending ids) for each query, among the cells it probes and not below its floor."""
    score = queries @ vectors.T
    score[~probed[:, cells]] = -np.inf
    score[query_ids[:, None] == ids[None, :]] = -np.inf
    # The exact products then decide, equal ones by id.
    near = (score >= np.maximum(floor, _floor(score, n))[:, None]) & (score > -np.inf)
    row, col = np.nonzero(near)
    exact = (queries[row] * vectors[col]).sum(axis=1)
    order = np.lexsort((ids[col], -exact, row))
    row, col, exact = row[order], col[order], exact[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    keep = place < n
    yield query_ids[row[keep]], ids[col[keep]], exact[keep]


def search(embeddings: DataFrame, is_query: Column, neighbours: int = 20, most_sample: int = MOST_SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector that ``is_query`` names its nearest others by inner product.

    Nearest first, equal scores by smaller id; all others, where there are fewer.
    Vectors that are NULL, empty, zero or not finite, and ids that are NULL, take no
    part; neither do vectors of another length than most.  Of equal vectors only the
    ``neighbours`` + 1 smallest ids are indexed, as no list can reach the others.
    An empty table gives an empty table.
    """
    spark = embeddings.sparkSession
    vectors = _vectors(embeddings)
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    indexed = stored(vectors.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= neighbours + 1).drop("copy"), "indexed")
    total = indexed.count()
    result = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], result)
    share = min(1.0, most_sample / total)
    picked = indexed.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)).toArrow()
    picked = (picked if picked.num_rows else indexed.limit(1).toArrow()).sort_by("vec_id")  # reruns fit the same index
    sample = _matrix(picked.column("embedding"))
    index = fit(sample, neighbours, recall=recall)
    # Sent once to each executor; at most ``most_sample`` vectors.
    shared = spark.sparkContext.broadcast((picked.column("vec_id").to_numpy(), sample, index.cell(sample)))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index.cell(x), pa.int32()), batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["cell", "vec_id", "vector"])

    placed = stored(indexed.mapInArrow(assign, "cell int, vec_id long, vector binary"), "cells")
    # At most MOST_CENTROIDS squared rows.
    counts = np.zeros(index.cells, np.int64)
    for r in placed.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    parts = np.maximum(1, -(-counts // SHARD_ROWS))
    offset = np.cumsum(parts) - parts
    shards = max(buckets_for(spark) // 4, math.ceil(total / SHARD_ROWS))
    shard_of = np.arange(int(parts.sum())) % shards
    width, enough = sample.shape[1], max(index.share * total, neighbours + 1)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            part = offset[cell] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % parts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(shard_of[part], pa.int32()), *batch.columns], names=["shard", "cell", "vec_id", "vector"])

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = counts.tolist()
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                block = batch.slice(at, QUERY_BLOCK)
                x = _matrix(block.column(1))
                probed = np.zeros((len(x), index.cells), bool)
                for k, q in enumerate(x):
                    probed[k, index.visit(q, plain, enough)] = True
                wanted = np.zeros(shards, bool)
                for cell in np.flatnonzero(probed.any(axis=0)):
                    wanted[shard_of[offset[cell]:offset[cell] + parts[cell]]] = True
                to = np.flatnonzero(wanted)
                ids = np.asarray(block.column(0))
                # No list can end below what the sample's vectors in the probed cells already reach.
                known, vectors, cells = shared.value
                score = np.where(probed[:, cells] & (ids[:, None] != known[None, :]), x @ vectors.T, -np.inf)
                packed = [ids.tobytes(), x.tobytes(), np.packbits(probed, axis=1).tobytes(), _floor(score, neighbours).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *(pa.array([p] * len(to), pa.binary()) for p in packed)],
                                                 names=["shard", "ids", "queries", "probed", "floor"])

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            order = np.argsort(left.column("vec_id").to_numpy())
            ids, cells = left.column("vec_id").to_numpy()[order], left.column("cell").to_numpy()[order]
            x = np.frombuffer(b"".join(left.column("vector").to_pylist())).reshape(-1, width)[order]
            for q, queries, bits, floor in zip(*(right.column(c) for c in ("ids", "queries", "probed", "floor")), strict=True):
                q = np.frombuffer(q.as_py(), np.int64)
                probed = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8).reshape(len(q), -1), axis=1, count=index.cells).astype(bool)
                found += _best(q, np.frombuffer(queries.as_py()).reshape(-1, width), probed, np.frombuffer(floor.as_py()), ids, x, cells, neighbours)
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    queries = vectors.filter(is_query).mapInArrow(ask, "shard int, ids binary, queries binary, probed binary, floor binary")
    dealt = placed.mapInArrow(deal, "shard int, cell int, vec_id long, vector binary")
    near = dealt.groupBy("shard").cogroup(queries.groupBy("shard")).applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
