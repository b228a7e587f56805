"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import multi_index

from .conftest import CLASHING

IS_QUERY = "vec_id % 20 = 0"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("own") for c in (*CLASHING, "rank", "shard", "copy", "n") if c != "label"})


def brute(ids, x, q, n):
    """(id, score) of the n nearest of a query, products in double precision."""
    score = (x * x[q]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -score)) if i != q][:n]
    return [(int(ids[i]), score[i]) for i in order]


def recall(spark, rows, n=20, **options):
    got = {}
    for r in multi_index.search(frame(spark, rows), F.expr(IS_QUERY), n, **options).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    place, hit, total = {int(i): k for k, i in enumerate(ids)}, 0, 0
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for q, found in got.items():
        want = brute(ids, x, place[q], n)
        assert sorted(found) == list(range(1, len(want) + 1))
        listed = [found[k] for k in sorted(found)]
        assert listed == sorted(listed, key=lambda v: (-v[1], v[0])) and q not in [v for v, _ in listed]
        for v, s in listed:
            assert s == pytest.approx((x[place[v]] * x[place[q]]).sum(), abs=1e-12)
        hit += len({v for v, _ in listed} & {v for v, _ in want})
        total += len(want)
    return hit / total


def test_table_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert recall(spark, rows) >= 0.9


def test_clusters_are_found_in_few_cells(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 3
    x = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.3
    index = multi_index.fit(x, 20)
    assert index.share < 0.25
    assert recall(spark, [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]) >= 0.9


def test_exact_with_all_cells(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "SHARD_ROWS", 50)
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, (400, 6)).astype(np.float32)  # many ties and copies
    x[~x.any(axis=1)] = 1
    x[100:300] = x[7]
    assert recall(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)], recall=1.0) == 1.0


def test_cells_come_by_summed_score():
    rng = np.random.default_rng(6)
    index = multi_index.MultiIndex(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    q, counts = rng.normal(size=6), rng.integers(0, 4, 35).tolist()
    total = ((index.first @ q[:3])[:, None] + (index.second @ q[3:])[None]).ravel()
    full = [c for c in np.argsort(-total) if counts[c]]
    assert index.visit(q, counts, np.inf) == full
    some = index.visit(q, counts, 10)
    assert some == full[:len(some)] and sum(counts[c] for c in some) >= 10 > sum(counts[c] for c in some[:-1])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (40, [0.0, 0.0], 1), (60, None, 1), (80, [1.0, None], 1), (100, [nan, 1.0], 1),
            (120, [inf, 1.0], 1), (140, [], 1), (160, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (3, [2.0, 2.0], None), (1, [2.0, 2.0], 1), (2, [-1.0, 0.0], 1)]
    got = [tuple(r) for r in multi_index.search(frame(spark, rows), F.expr(IS_QUERY), 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 3, 2.0), (0, 3, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 3, 2.0), (20, 3, 0, 0.0)]
    assert multi_index.search(frame(spark, rows).filter("false"), F.expr(IS_QUERY)).collect() == []
    assert multi_index.search(frame(spark, rows[:1]), F.expr(IS_QUERY)).collect() == []
