"""A quality score from document statistics: random Fourier features, ridge, isotonic calibration.

Statistics of the whole text (never its label, language, source or id) are standardised
and mapped to cosines that approximate a Gaussian kernel.  Each partition of the labelled
rows adds up its share of the normal equations, per fold; the sums are solved on the
driver, where they are FEATURES + 1 squared whatever the number of rows.  Scores of the
rows a fold left out are counted in bins, and the pooled-adjacent-violators fit of those
bins calibrates the model of all folds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Labelled rows the model is fitted on, at most: a hash of the id chooses them.
MOST_TRAINING = 200_000
FEATURES = 256
#: Width of the kernel in standard deviations of all statistics together, and the ridge.
WIDTH = 1.0
RIDGE = 0.3
FOLDS = 4
BINS = 400
#: Standardised statistics are held within these bounds.
CLIP = 5.0

_SYMBOLS = b"#*$%&|<>"
_STATS = (
    "log_words", "log_lines", "word_length", "words_per_line", "upper", "digits", "symbols", "bars", "exclaims", "stops",
    "commas", "other_marks", "non_ascii", "spaces", "distinct_words", "distinct_lines", "short_words", "top_word", "long_words", "upper_words",
)


def _kinds() -> np.ndarray:
    kind = np.zeros((10, 256))
    kind[0, 65:91] = kind[1, 48:58] = 1
    for row, chars in ((2, _SYMBOLS), (3, b"|"), (4, b"!"), (5, b"."), (6, b","), (8, b" \t\n\x0b\x0c\r")):
        kind[row, list(chars)] = 1
    marks = [c for c in range(33, 127) if not chr(c).isalnum() and c not in _SYMBOLS + b"!.,"]
    kind[7, marks] = 1
    kind[9, 128:] = 1
    return kind


_KINDS = _kinds()


def text_stats(text: bytes | None) -> list[float]:
    """The statistics of one text; zeros without words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(_STATS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = (_KINDS @ counts / len(text)).tolist()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper, digits, symbols, bars, exclaims, stops, commas, other, spaces, high = share
    return [
        float(np.log1p(n)), float(np.log1p(len(lines))), float(np.log1p(lengths.mean())), float(np.log1p(n / len(lines))),
        upper ** 0.5, digits ** 0.5, symbols ** 0.5, bars ** 0.5, exclaims ** 0.5, stops ** 0.5, commas ** 0.5, other ** 0.5, high ** 0.5,
        spaces ** 0.5, len(seen) / n ** 0.9, len(set(lines)) / len(lines), float((lengths <= 3).mean()), max(seen.values()) / n,
        float((lengths > 20).mean()) ** 0.5, sum(map(bytes.isupper, words)) / n]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the statistics of every document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            # One text at a time: a batch holds the texts once, not all their words.
            rows = [text_stats(x.as_py()) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def held_out(doc_id: Column) -> Column:
    """Rows a label is never learned from; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


@dataclass
class Features:
    """Standardised statistics to cosines; drawn from a fixed seed."""

    mean: np.ndarray
    scale: np.ndarray
    size: int = FEATURES
    width: float = WIDTH

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(7)
        directions = rng.normal(size=(len(self.mean), self.size)) / (self.width * len(self.mean) ** 0.5)
        phases = rng.uniform(0, 2 * np.pi, self.size)
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        return np.c_[np.ones(len(x)), np.cos(x @ directions + phases) * (2 / self.size) ** 0.5]


@dataclass
class Model:
    features: Features
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def normal_sums(train: DataFrame, features: Features, folds: int) -> np.ndarray:
    """(folds, size + 1, size + 2): Z'Z beside Z'y of each fold, summed in partitions and then by row."""
    size = features.size + 1

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((folds, size, size + 1))
        for batch in batches:
            z = features(_matrix(batch.column(0)))
            zy = np.c_[z, np.asarray(batch.column(1))]
            fold = np.asarray(batch.column(2))
            for k in range(folds):
                sums[k] += z[fold == k].T @ zy[fold == k]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(folds * size)), pa.array(list(sums.reshape(folds * size, -1)))], names=["i", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum(np.stack(table.column("sums").to_pylist()), axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "sums": pa.array([total])})

    rows = (train.select("stats", "y", "fold").mapInArrow(part, "i long, sums array<double>")
            .groupBy("i").applyInArrow(add, "i long, sums array<double>").collect())
    out = np.zeros((folds * size, size + 1))
    for r in rows:
        out[r.i] = r.sums
    return out.reshape(folds, size, size + 1)


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights; the constant is not shrunk."""
    penalty = np.full(len(sums), ridge)
    penalty[0] = 1e-9
    return np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1])


def pool(means: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest ascending values: neighbours that fall are pooled to their mean."""
    blocks: list[list[float]] = []
    for m, w in zip(means.tolist(), weights.tolist(), strict=True):
        blocks.append([m, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks[-1]
            a[0], a[1], a[2] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]
    return np.concatenate([np.full(n, m) for m, _, n in blocks])


def fit(stats: DataFrame, labels: DataFrame, most: int = MOST_TRAINING, ridge: float = RIDGE) -> Model:
    """Fit on the labelled rows that are not held out; without labels of both kinds every score is their share, or one half."""
    marks = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("id_")).agg(F.avg("quality").alias("y")))
    share = min(1.0, most / max(1, marks.count()))
    marks = marks.filter(F.pmod(F.xxhash64("id_"), F.lit(1_000_000)) < round(share * 1_000_000))
    fold = F.pmod(F.xxhash64("id_", F.lit(1)), F.lit(FOLDS)).cast("int")
    train = stored(stats.join(marks, stats["doc_id"] == marks["id_"]).select("stats", "y", fold.alias("fold")), "training")
    size = len(_STATS)
    row = train.agg(F.count(F.lit(1)), F.avg("y"), *[F.avg(F.col("stats")[i]) for i in range(size)], *[F.stddev(F.col("stats")[i]) for i in range(size)]).first()
    n, share = row[0], row[1]
    if not n or share in (0.0, 1.0):
        flat = Features(np.zeros(size), np.ones(size), 1)
        return Model(flat, np.zeros(2), np.zeros(1), np.array([0.5 if share is None else share]))
    scale = np.array([x or 0.0 for x in row[2 + size:]])
    features = Features(np.array(row[2:2 + size]), np.where(scale > 1e-9, scale, 1.0))
    sums = normal_sums(train, features, FOLDS)
    total = sums.sum(axis=0)
    weights = solve(total, ridge)
    each = [solve(total - s, ridge) for s in sums]

    def left_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, k = features(_matrix(batch.column(0))), np.asarray(batch.column(2))
            raw = (z * np.stack(each)[k]).sum(axis=1)
            bins = np.clip(((raw + 0.5) * (BINS / 2)).astype(np.int64), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["bin", "y"])

    binned = (train.mapInArrow(left_out, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n"))
              .orderBy("bin").collect())
    count = np.array([b.n for b in binned], float)
    values = pool(np.array([b.y for b in binned]) / count, count)
    knots = (np.array([b.bin for b in binned]) + 0.5) * (2 / BINS) - 0.5
    return Model(features, weights, knots, values)


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINING) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (score of one half or more).

    NULL and empty texts have statistics of zero and a score like any other.  A label
    that is NULL or not 0 or 1 is passed over; repeated labels of one id count as their
    mean; repeated documents are scored alike.  An empty table gives an empty table.
    """
    stats = stored(statistics(docs), "stats")
    model = fit(stats, labels, most)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.score(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
