"""Held-out accuracy, calibration, and what a score may depend on."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import quality_model

from .conftest import prose


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("stats", F.lit("own"))


def scores(docs, labels, **options):
    return quality_model.quality_scores(docs, labels, **options).collect()


def test_pool_is_the_nearest_ascending_fit():
    rng = np.random.default_rng(2)
    for _ in range(50):
        y, w = rng.normal(size=12), rng.integers(1, 9, 12).astype(float)
        got = quality_model.pool(y, w)
        # Least squares under an ascending order: the largest of the smallest means.
        mean = lambda a, b: (y[a:b + 1] * w[a:b + 1]).sum() / w[a:b + 1].sum()  # noqa: E731, B023
        want = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert got == pytest.approx(want)


def test_normal_sums_solve_the_ridge(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(300, len(quality_model._STATS))), rng.integers(0, 2, 300)
    features = quality_model.Features(x.mean(axis=0), x.std(axis=0), 20)
    train = spark.createDataFrame([(r.tolist(), float(t), int(k % 3)) for k, (r, t) in enumerate(zip(x, y, strict=True))], "stats array<double>, y double, fold int")
    sums = quality_model.normal_sums(train.repartition(5), features, 3).sum(axis=0)
    z = features(x)
    penalty = np.diag(np.r_[1e-9, np.full(20, 0.5)])
    assert quality_model.solve(sums, 0.5) == pytest.approx(np.linalg.solve(z.T @ z + penalty, z.T @ y))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in scores(docs, labels)}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([q == g.predicted for q, g in held]) > 0.97
    assert np.mean([(q - g.score) ** 2 for q, g in held]) < 0.03


def corpus(n, seed=1):
    r = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        good = r.random() < 0.7
        text = prose(i, 60) if good else " ".join(w + r.choice(["###", "$$$", "%%%"]) for w in prose(i, 60).split())
        rows.append((i, text, "s"))
        marks.append((i, int(good), 0))
    return rows, marks


def test_only_texts_and_training_labels_count(spark, docs_of):
    rows, marks = corpus(240)
    base = {r.doc_id: r.score for r in scores(docs_of(rows), labels_of(spark, marks))}
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 1) for i, q, _ in marks]
    other = [(i, t, f"src{i % 7}") for i, t, _ in rows]
    again = {r.doc_id: r.score for r in scores(docs_of(other, clashing=False).withColumn("lang", F.lit(None).cast("string")), labels_of(spark, flipped))}
    assert again == pytest.approx(base)


def test_edges(spark, docs_of, edge_rows, no_rows):
    rows, marks = corpus(150)
    docs = docs_of(edge_rows + [(1000 + i, t, s) for i, t, s in rows])
    bad = [(1000 + i, q, t) for i, q, t in marks] + [(1, None, 0), (None, 1, 0), (2, 7, 0), (1003, 0, 0), (1003, 1, 0)]
    got = scores(docs, labels_of(spark, bad))
    assert len(got) == len(edge_rows) + len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    assert scores(no_rows, labels_of(spark, marks)) == []
    assert {r.score for r in scores(docs, labels_of(spark, []))} == {0.5}
    assert {r.score for r in scores(docs, labels_of(spark, [(i, 1, 0) for i in range(1000, 1100)]))} == {1.0}


def test_sample_bound(spark, docs_of):
    rows, marks = corpus(300)
    got = {r.doc_id: r.predicted for r in scores(docs_of(rows), labels_of(spark, marks), most=80)}
    assert np.mean([got[i] == q for i, q, _ in marks]) > 0.9
