"""Runs against every stretch and every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import periodic_runs

from .conftest import prose


def brute(w):
    """All runs of a list of words as (start, length, period), by comparing at every distance."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    _, codes, bounds = periodic_runs.number_words([" ".join(t).encode() for t in texts])
    text, *runs = periodic_runs.find_runs(codes, bounds)
    rows = list(zip(text.tolist(), *[r.tolist() for r in runs], strict=True))
    return [[r[1:] for r in rows if r[0] == k] for k in range(len(texts))]


def collapsed(w):
    gone = {i for s, n, q in brute(w) for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
    return [x.decode() for x in w]


def digest(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (str(doc_id), len(runs), s, n, q, None if n is None else 1000 * n // q, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(w).encode()).hexdigest())


def test_small_alphabets():
    r = random.Random(11)
    for _ in range(150):
        texts = []
        for _ in range(r.randrange(1, 10)):
            k, w = r.choice([1, 2, 3, 5, 30]), []
            while len(w) < r.randrange(60):
                p = [f"w{r.randrange(k)}" for _ in range(r.randrange(1, 7))]
                w += p * r.choice([1, 1, 2, 4, 5, 9]) + p[:r.randrange(len(p) + 1)]
            texts.append(w)
        assert found(texts) == [brute(w) for w in texts]


def test_words_of_binary_numbers_and_fibonacci():
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    thue = "".join(str(bin(i).count("1") % 2) for i in range(256))
    texts = [list(fib[-1]), list(thue), list("ab" * 40 + "a"), list("aab" * 4 + "b" + "aab" * 5), []]
    assert found(texts) == [brute(w) for w in texts]


def test_limits_of_length():
    texts = [["a"] * 5, ["a"] * 6, list("abababa"), list("abababab"), list("abcabcabcab"), list("abcabcabcabc")]
    assert found(texts) == [[], [(0, 6, 1)], [], [(0, 8, 2)], [], [(0, 12, 3)]]


def test_long_texts():
    period = [f"w{i}" for i in range(997)]
    ones, mixed = ["x"] * 200_000, period * 300 + period[:10]
    assert found([ones, prose(1, 5000).split() + mixed]) == [[(0, 200_000, 1)], [(5000, 300 * 997 + 10, 997)]]


def test_rows_of_runs(edges, edge_rows):
    got = sorted((str(r.doc_id), r.start, r.length, r.period) for r in periodic_runs.periodic_runs(edges).collect())
    assert got == sorted((str(i), *r) for i, t, _ in edge_rows for r in brute((t or "").split()[:6000] if i != 8 else []))


def test_collapsed_texts_and_other_columns(edges, edge_rows):
    out = periodic_runs.collapse_runs(edges)
    assert out.columns == edges.columns
    rows = out.collect()
    want = [(str(i), collapsed(t.split()) if i == 9 else t) for i, t, _ in edge_rows]
    assert sorted(((str(r.doc_id), r.text) for r in rows), key=str) == sorted(want, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.key == "own key" for r in rows)


@pytest.mark.parametrize("name", ["edges", "documents", "no_rows"])
def test_digests(request, name):
    docs = request.getfixturevalue(name).withColumns({c: F.lit(c) for c in ("h", "g", "start", "n_runs")})
    rows = [r for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 30_000]
    few = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 30_000)
    got = [(str(r.doc_id), *r[1:]) for r in periodic_runs.runs_report(periodic_runs.with_planted_periods(few)).collect()]
    assert sorted(got, key=str) == sorted((digest(*r) for r in rows), key=str)


def test_planting_of_long_texts(edges):
    long = edges.filter("doc_id = 8").select(F.explode(F.sequence(F.lit(0), F.lit(40))).alias("doc_id"), "text")
    for r in periodic_runs.with_planted_periods(long).collect():
        assert r.text.split() == planted(r.doc_id, long.first().text)


def test_dropped_words():
    got = periodic_runs.dropped_words(10, np.array([0, 3]), np.array([6, 6]), np.array([1, 1]))
    assert got.tolist() == [False, True, True, True, True, True, True, True, True, False]
