"""Targets and copies against a plain water level."""

import random
import re
from collections import defaultdict

import pytest

from rillmart.llm import mixing


def targets(sizes):
    """Shares by weight, the excess over three times the size shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        free = total - sum(fixed.values())
        share = {s: free * weight[s] / sum(weight[x] for x in rest) for s in rest} if rest else {}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 3 * sizes[s] for s in over})


def check(docs):
    rows = mixing.mix_report(docs).collect()
    source = defaultdict(list)
    texts = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    by_id = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), sizes[s]): s for i, t, s in texts}
    assert len(rows) == len(texts)
    for r in rows:
        s = by_id[r.doc_id, r.size, r.source_size]
        assert r.target == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        rate = r.target / r.source_size if r.source_size else 0
        assert not r.size or r.taken // r.size in (int(rate), int(rate) + 1)
        source[s].append(r)
    return rows, source, want


def test_targets_and_totals(documents):
    rows, source, want = check(documents)
    for s, rs in source.items():
        assert sum(r.taken for r in rs) == pytest.approx(want[s], abs=max(r.size for r in rs))
    again = mixing.mix_report(documents.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_edges(edges, no_rows):
    check(edges)
    assert mixing.mix_report(no_rows).collect() == [] and mixing.mix(no_rows).columns == no_rows.columns


def test_capped_sources(docs_of):
    # The heavy weight falls on a source too small for it.
    rows, source, want = check(docs_of([(1, "a b", "a"), (2, "c " * 500, "b"), (3, "d " * 900, "c"), (4, "", "d"), (5, "e " * 50, None)]))
    assert want["a"] == 6 and {r.taken for r in source["a"]} == {6}


def test_copies_are_emitted(documents):
    copies = {r.doc_id: r.mix_.copies for r in mixing.mix_plan(documents).collect()}
    emitted = defaultdict(int)
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    for r in mixed.collect():
        emitted[r.doc_id] += 1
    assert emitted == {i: n for i, n in copies.items() if n}


def test_one_source_and_ties(docs_of):
    rows, _, _ = check(docs_of([(i, "same words here", "s") for i in range(50)]))
    assert sum(r.taken for r in rows) == 150


def test_many_sources_are_ranked_in_ranges(spark, monkeypatch):
    plans, weights, kept = [], {}, mixing.stored

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = kept(df, label)
        if label == "sources":
            weights.update({r.source: r.weight for r in out.collect()})
        return out

    monkeypatch.setattr(mixing, "stored", noted)
    names = [f"s{i * 7919 % 1000}" for i in range(300)] + ["", "\u00e9", "\U0001f600", "\uffff"]
    mixing.source_targets(spark.createDataFrame([(s, 10) for s in [*names, None]], "source string, size long")).collect()
    order = [*sorted(set(names), key=lambda s: s.encode()), None]
    assert weights == {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    assert any("rangepartitioning" in p for p in plans)


def test_levels_of_many_sources(spark):
    """Sizes over six powers of ten, with ties and empty sources, so that many sources stop before the level."""
    rng = random.Random(3)
    sizes = {f"s{i:03d}": rng.choice([0, 7, 7, int(10 ** rng.uniform(0, 6))]) for i in range(150)} | {None: 10 ** 7}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = targets(sizes)
    assert {r.source: r.source_size for r in got} == sizes
    assert sum(abs(want[s] - 3 * sizes[s]) < 1e-9 for s in sizes) > 20
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
