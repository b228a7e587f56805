"""Groups, links and counts of pairs against the two libraries and plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from rillmart.llm import token_alignment as ta
from rillmart.llm.queries import piece_model, tokenizer_file

A_PATH = tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def sides():
    with open(A_PATH, "rb") as f, open(piece_model(), "rb") as g:
        return ta.ByteBpe(f.read()), ta.PieceBpe(g.read())


def byte_table():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


BYTES = byte_table()


def groups(libraries, text):
    """Lists of (A ids, B ids)."""
    a, b = libraries
    if not text:
        return []
    one = a.encode(" " + text, add_special_tokens=False)
    a_ids, a_bytes = one.ids, [bytes(BYTES[c] for c in t) for t in one.tokens]
    ids = b.encode(text)
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids]
    if b"".join(a_bytes) != b" " + text.encode() or b"".join(b_bytes) != b" " + text.encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        p, q = np.searchsorted(ends_a, end, "right"), np.searchsorted(ends_b, end, "right")
        out.append((a_ids[i:p], ids[j:q]))
        i, j = p, q
    return out


def report(libraries, rows):
    per = [(i, groups(libraries, t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in per]
    held = Counter(p for n in links for p in n)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (i, g), n in zip(per, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((str(i), sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(n.values()),
                    sum(k for p, k in n.items() if held[p] == most[p[0]]), sum(k * held[p] for p, k in n.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out)


def own(docs, **limits):
    rows = ta.alignment_report(docs, A_PATH, piece_model(), **limits).collect()
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows)


HARD = ["", " ", "  a", "<|endoftext|> <s> </s> <0x41>", "▁x", "日本語 テキスト 😀", "a\x00b\x85c\xa0d　e", "don't we'll I'M", "aaaa" * 3000, "\n\n \t x", "é́ ﬁ①",
        "0123456789" * 40, "=" * 500 + " " * 300, "ab" * 777 + "日" * 50]


def test_sides_encode_as_their_libraries(sides, libraries):
    r = random.Random(5)
    parts = ["th", "at", "the", "'s", "'S", " ", "  ", "\n", "\t", "é", "日", "😀", "1", "12", "=", "--", "\xa0", "\x85", " ", "á", "ǅ", "²", "ª", "_"]
    texts = HARD + ["".join(r.choice(parts) for _ in range(r.randrange(1, 60))) for _ in range(2000)]
    a, b = sides
    assert a.encode(texts) == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert b.encode(texts) == [libraries[1].encode(t) for t in texts]


def test_every_character_class(sides, libraries):
    """The two byte-level encoders cut alike: every 37th code point, in each place a class can show."""
    points = [c for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000] + list(range(0x3000))
    texts = [f"a{c}b 1{c}2 {c} {c}{c}.{c}! {c}'s" for c in map(chr, points)]
    assert sides[0].encode(texts) == [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_chunks(sides, libraries, monkeypatch):
    monkeypatch.setattr(ta, "MOST_LINKS", 50)
    monkeypatch.setattr(ta, "LARGE_GROUP", 6)
    chunk = ta.Aligned(*sides, [None, *HARD, None])
    radix = ta._radix(sides[0].n)
    doc, pair, links = chunk.records()
    back = np.argsort(radix)
    got = {(int(d), int(back[p >> ta.ID_BITS]), int(p & (2 ** ta.ID_BITS - 1))): int(n) for d, p, n in zip(doc, pair, links, strict=True)}
    want = Counter((k + 1, x, y) for k, t in enumerate(HARD) for a, b in groups(libraries, t) for x in a for y in b)
    assert got == dict(want)
    assert chunk.links().tolist() == [0, *[sum(len(a) * len(b) for a, b in groups(libraries, t)) for t in HARD], 0]


def test_merge_of_runs():
    r = np.random.default_rng(2)
    keys = [np.unique((r.integers(0, 9, n) << ta.ID_BITS | r.integers(0, 5, n)).astype(np.uint64)) for n in (0, 1, 30, 40, 7)]
    held = [r.integers(1, 4, len(k)) for k in keys]
    total, most = Counter(), Counter()
    for k, h in zip(keys, held, strict=True):
        for x, n in zip(k.tolist(), h.tolist(), strict=True):
            total[x] += n
    for x, n in total.items():
        most[x >> ta.ID_BITS] = max(most[x >> ta.ID_BITS], n)
    want = [[2 * total[x] + (total[x] == most[x >> ta.ID_BITS]) for x in k.tolist()] for k in keys]
    assert [x.tolist() for x in ta.merge_runs(keys, held)] == want


@pytest.mark.parametrize("limits", [{}, {"buckets": 3, "most_records": 40}, {"most_documents": 2, "buckets": 50}])
def test_edges(docs_of, edges, edge_rows, libraries, limits):
    rows = [(i, t) for i, t, _ in edge_rows] + [(100 + k, t) for k, t in enumerate(HARD)]
    assert own(docs_of([(i, t, "s") for i, t in rows]).coalesce(2), **limits) == report(libraries, rows)


def test_whole_table(documents, libraries):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert own(documents) == report(libraries, rows)


def test_no_rows_and_no_tokens(no_rows, docs_of):
    assert own(no_rows) == []
    assert own(docs_of([(1, None, "s"), (None, "", None)])) == [("1", 0, 0, 0, 0, 0, 0, ""), ("None", 0, 0, 0, 0, 0, 0, "")]


def test_groups(edges, edge_rows, libraries):
    out = ta.align(edges.withColumn("groups", F.lit("own")), A_PATH, piece_model())
    assert out.columns == [*edges.columns, "groups"]
    got = sorted((str(r.doc_id), [(g.a, g.b) for g in r.groups]) for r in out.filter("coalesce(n_chars, 0) < 20000").collect())
    assert got == sorted((str(i), [(list(a), list(b)) for a, b in groups(libraries, t)]) for i, t, _ in edge_rows if len(t or "") < 20000)
