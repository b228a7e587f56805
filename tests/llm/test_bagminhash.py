"""Signatures against the weighted Jaccard similarity; classes against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from rillmart.llm import bagminhash, grams
from rillmart.llm.components import components

from .conftest import prose


def bag(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def classes(texts, least=0.8):
    """Class number of each text by all pairs."""
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(texts)):
        for y in range(x):
            if (texts[x] or "") == (texts[y] or "") or (bags[x] and bags[y] and jaccard(bags[x], bags[y]) >= least - 1e-12):
                parent[find(x)] = find(y)
    return [find(x) for x in range(len(texts))]


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    found = classes([r.text for r in rows])
    smallest = {}
    for r, c in zip(rows, found, strict=True):
        if r.doc_id is not None:
            smallest[c] = min(smallest.get(c, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, smallest.get(c), sum(bag(r.text).values())) for r, c in zip(rows, found, strict=True))
    assert Counter((r.doc_id, r.class_id, r.n_shingles) for r in bagminhash.near_classes(docs).collect()) == want
    kept = bagminhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((smallest.get(c) for c in set(found)), key=str)


@pytest.mark.parametrize("most", [1, 4, 600])
def test_signatures_estimate_weighted_jaccard(most):
    rng = np.random.default_rng(most)
    a = Counter({k: int(rng.integers(1, most + 1)) for k in range(120)})
    b = Counter(a)
    for k in range(25):
        b[k] = int(rng.integers(1, most + 1))
        b[1000 + k] = int(rng.integers(1, most + 1))
    agree = []
    for salt in range(30):
        code = grams.mix(np.array([*a, *b], np.uint64) + np.uint64(salt * 10_000))
        doc, weight = np.repeat([0, 1], [len(a), len(b)]), np.array([*a.values(), *b.values()])
        s = bagminhash.bag_signatures(code, doc, weight, 2)
        assert np.isfinite(s).all()
        agree.append((s[0] == s[1]).mean())
    assert np.mean(agree) == pytest.approx(jaccard(a, b), abs=0.03)


def test_a_larger_weight_only_adds_points():
    code = grams.mix(np.arange(5, dtype=np.uint64))
    earlier = np.full((1, bagminhash.REGISTERS), np.inf)
    for w in (1, 2, 3, 9, 1025):
        now = bagminhash.bag_signatures(code, np.zeros(5, int), np.full(5, w), 1)
        assert (now <= earlier).all()
        earlier = now


def test_documents(documents, edges):
    check(documents)
    check(edges)


def near_copies(seed, n, edits):
    r, base = random.Random(seed), prose(seed, 150).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(len(w))] = f"edit{r.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_links_beyond_the_pivot(docs_of):
    # Near 0.8 many members of a bucket are unlike its pivot but like each other.
    texts = near_copies(1, 30, 2) + near_copies(2, 30, 4) + near_copies(3, 10, 1) + [prose(9, 100)] * 5
    check(docs_of([(1000 - i, t, "s") for i, t in enumerate(texts)]))


def test_chain(docs_of):
    # Each text is like the next one only.
    w = prose(5, 120).split()
    texts = []
    for i in range(12):
        w = w[6:] + prose(700 + i, 6).split()
        texts.append(" ".join(w))
    check(docs_of([(i, t, "s") for i, t in enumerate(texts)]))


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    label = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.node: x.label for x in got} == label


def test_empty(no_rows):
    assert bagminhash.class_report(no_rows).collect() == [] and bagminhash.keep_first(no_rows).collect() == []
