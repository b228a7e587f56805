"""Ids and texts against the library."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from rillmart.llm import sentencepiece_bpe
from rillmart.llm.queries import piece_model


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def encoder():
    with open(piece_model(), "rb") as f:
        return sentencepiece_bpe.Encoder(sentencepiece_bpe.Pieces(f.read()))


def same(encoder, library, texts):
    ids, bounds = encoder.encode(texts)
    for k, t in enumerate(texts):
        own = ids[bounds[k]:bounds[k + 1]]
        assert own.tolist() == library.encode(t), t[:200]
        assert encoder.pieces.decode(own) == library.decode(own.tolist())


def test_hand_made(encoder, library):
    same(encoder, library, ["", " ", "   ", "a", " a  b\n", "▁x", "▁▁ x ▁", "é ﬁ①", "\x00a﻿b", "<s> <0x0A> </s>", "日本語 テキスト 😀", "\xa0x　y",
                            "a" * 50_000, "thatio" * 3000, "= " * 3000, "ioionionation" * 50])


def test_pieces_that_compete(encoder, library):
    r = random.Random(7)
    parts = ["th", "at", "the", "io", "n", "a", "aa", " ", "  ", "▁", "i", "for", "é", "😀", "\n", "on", "e", "r", "re", "ation", "11", "==", "--"]
    same(encoder, library, ["".join(r.choice(parts) for _ in range(r.randrange(1, 80))) for _ in range(3000)])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(encoder, library, text):
    same(encoder, library, [text])


def test_memory_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "MOST_UNITS", 10)
    for k in range(5):
        same(encoder, library, [f"word{k}{i} again" for i in range(8)])


def test_decoding_of_any_ids(encoder, library):
    r = np.random.default_rng(1)
    for _ in range(200):
        ids = r.integers(3, 400, r.integers(1, 30))
        assert encoder.pieces.decode(ids) == library.decode(ids.tolist())


def test_query_digests(documents, edges, no_rows, library):
    for docs in (documents, edges):
        rows = docs.select("doc_id", "text").collect()
        want = []
        for r in rows:
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            want.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_bpe.token_digests(docs, piece_model()).collect()]
        assert sorted(got) == sorted(want)
    assert sentencepiece_bpe.token_digests(no_rows, piece_model()).collect() == []


def test_round_trip(edges):
    encoded = sentencepiece_bpe.encode(edges, piece_model())
    assert encoded.columns == [*edges.columns, "ids"]
    back = sentencepiece_bpe.decode(encoded, piece_model())
    texts = sorted((str(r.doc_id), (r.text or "").replace("▁", " ")) for r in edges.collect())
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == texts
