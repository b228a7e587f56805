"""Scores against counts in dictionaries."""

import math
from collections import Counter, defaultdict

import pytest

from rillmart.llm import backoff_lm, grams


def brute(rows, alpha):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    every, total = Counter(), 0
    runs = lambda w: Counter(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for _, w in texts:
        total += len(w)
        every.update(runs(w))
    out = []
    for i, w in texts:
        own, score = runs(w), 0.0
        n = lambda *g: every[g] - own[g]  # noqa: E731, B023
        for p in range(len(w)):
            if p >= 2 and n(*w[p - 2:p + 1]):
                score += math.log(n(*w[p - 2:p + 1]) / n(*w[p - 2:p]))
            elif p >= 1 and n(*w[p - 1:p + 1]):
                score += math.log(n(*w[p - 1:p + 1]) / n(w[p - 1]) * (alpha if p >= 2 else 1))
            else:
                score += math.log(max(n(w[p]), 0.5) / max(total - len(w), 1) * alpha ** min(p, 2))
        out.append((i, len(w), score))
    return out


@pytest.mark.parametrize("alpha", [0.4, 1.0])
def test_scores(documents, edges, monkeypatch, alpha):
    monkeypatch.setattr(grams, "BLOCK_ROWS", 20)
    for docs in (documents, edges):
        want = defaultdict(list)
        for i, n, s in brute([(r.doc_id, r.text) for r in docs.collect()], alpha):
            want[i, n].append(s)
        got = defaultdict(list)
        for r in backoff_lm.backoff_scores(docs, alpha).collect():
            got[r.doc_id, r.n_words].append(r.log_score)
            assert (r.mean_score is None) == (r.n_words == 0)
        assert got.keys() == want.keys()
        for k in want:
            assert sorted(got[k]) == pytest.approx(sorted(want[k]), rel=1e-9)


def test_text_like_the_corpus_scores_higher(docs_of):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug", "s") for i in range(5)] + [(9, "zq xv jj kk ww pp", "s")]
    score = {r.doc_id: r.mean_score for r in backoff_lm.backoff_scores(docs_of(rows)).collect()}
    assert score[0] > score[9]


def test_empty(no_rows):
    assert backoff_lm.backoff_scores(no_rows).collect() == []
