"""Removed words against a dictionary of all windows."""

import hashlib
import re
from collections import Counter

import pytest

from rillmart.llm import grams, substring_dedup

from .conftest import prose


def brute(rows, window):
    big = 2 ** 63 - 1
    texts = [(big if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, big), i)
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((None if i == big else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("window, seed", [(13, 7), (5, 5), (4, 1)])
def test_documents(documents, edges, window, seed):
    for docs in (documents, edges):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_report(docs, window, seed).collect())
        assert got == Counter(x[:4] for x in brute(rows, window))


def test_overlapping_sources_and_many_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(grams, "BLOCK_ROWS", 3)
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    rows = [(5, f"{a} {b}", "s"), (1, f"{b} {c}", "s"), (9, f"{c} {a} {b} {c}", "s"), (7, a, "s"), (8, "w " * 100, "s"), (3, "w " * 14, "s"),
            (11, " ".join(a.split()[5:30]), "s"), (12, " ".join(a.split()[5:17]), "s")]
    rows += [(100 + i, f"{prose(50 + i, 20)} {b}", "s") for i in range(20)]
    docs = docs_of(rows)
    want = brute([(i, t) for i, t, _ in rows], 13)
    got = {r.doc_id: (r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_report(docs).collect()}
    assert got == {x[0]: x[:4] for x in want}
    cut = substring_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r for r in cut.collect()}
    assert all(texts[x[0]].text == (x[4] if x[2] else dict((i, t) for i, t, _ in rows)[x[0]]) for x in want)
    assert all(r.n_chars == len(r.text) for r in texts.values())


def test_spans_hold_the_source_words(documents):
    words = {r.doc_id: r.text.split() for r in documents.collect()}
    spans = substring_dedup.repeated_spans(documents).collect()
    assert spans
    for s in spans:
        assert s.source_doc < s.doc_id and s.length >= 13
        assert words[s.doc_id][s.start:s.start + s.length] == words[s.source_doc][s.source_start:s.source_start + s.length]


def test_empty(no_rows):
    assert substring_dedup.dedup_report(no_rows).collect() == []
    assert substring_dedup.cut_repeats(no_rows).columns == no_rows.columns


def test_packing():
    import numpy as np

    keys = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (grams.unpack_sorted(grams.pack_sorted(keys)) == keys).all()
    ints = np.array([-5, 0, 7, 2 ** 62], np.int64)
    assert (grams.unpack(grams.pack(ints), np.int64) == ints).all()
    cut = grams.bucket_bounds(keys, 7)
    assert cut[0] == 0 and cut[-1] == 1000 and (np.diff(cut) > 80).all()


def test_blocks_of_long_texts_are_bounded_by_bytes(spark, monkeypatch):
    """Texts of a megabyte are dealt by bytes, and a passage that two of them share is cut from the later one."""
    monkeypatch.setattr(grams, "BLOCK_BYTES", 2 * 2 ** 20)
    docs = spark.range(40).selectExpr(
        "id as doc_id", "concat_ws(' ', transform(sequence(1, 100000), i -> concat('w', id, 'x', i)), if(id in (3, 30), repeat('a b c d e f g h i j k l m n o ', 1), '')) as text")
    blocks = grams.in_blocks(docs).groupBy("block_").count().collect()
    assert docs.selectExpr("min(octet_length(text))").first()[0] > 700_000
    assert len(blocks) >= 10  # by the number of texts it would be the four of the shuffle partitions
    gone = {r.doc_id: r.n_removed for r in substring_dedup.dedup_report(docs).collect()}
    assert gone == {i: 15 if i == 30 else 0 for i in range(40)}
