"""Stupid-backoff scores of documents against the rest of the corpus.

Count tables of one-, two- and three-word n-grams are partitioned by hash; each block
of documents sends its different n-grams with their counts and gets the corpus counts
back, which it joins to the n-grams of each document and sums.  Three-word n-grams are
counted only where both their word pairs occur in another document: the others cannot
occur elsewhere.  A document's own occurrences are taken off every count, so a text is
scored by what all other documents hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import buckets_for
from .grams import (
    Block,
    gram_codes,
    group_starts,
    in_blocks,
    inside,
    mix,
    pack,
    sizes_of,
    to_buckets,
    unpack,
    unpack_all,
    unpack_sorted,
)

#: Factor for each step back to a shorter history.
ALPHA = 0.4

_SENT = "bucket int, block int, keys binary, counts binary"
_BACK = "block int, bucket int, kind int, counts binary"
#: The n-gram of no word; its count is the corpus length.
_ALL = np.uint64(0x5851F42D4C957F2D)
_DOC = np.uint64(0x9E3779B97F4A7C15)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(keys)
    first = group_starts(ordered)
    return ordered[first], sizes_of(first, len(ordered))


class _Counts:
    """n-grams of one order in a block: code, document and position of each, counts in the block and in the own document."""

    def __init__(self, block: Block, k: int) -> None:
        self.at = np.flatnonzero(inside(block.doc, k))
        self.keys = gram_codes(block.codes, k, salt=k)[self.at]
        self.doc = block.doc[self.at]

    def own(self) -> np.ndarray:
        """How often the document of each n-gram holds it."""
        pair = mix(self.keys + (self.doc.astype(np.uint64) + np.uint64(1)) * _DOC)
        order = np.argsort(pair)
        size = sizes_of(group_starts(pair[order]), len(pair))
        out = np.empty(len(pair), np.int64)
        out[order] = np.repeat(size, size)
        return out

    def spread(self, keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """For each n-gram its total from an ascending table that holds it; 0 where the table does not."""
        if not len(keys):
            return np.zeros(len(self.keys), np.int64)
        distinct, back = np.unique(self.keys, return_inverse=True)
        at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
        return np.where(keys[at] == distinct, totals[at], 0)[back]


def _pairs_table(block: Block) -> tuple[np.ndarray, np.ndarray, list[_Counts]]:
    orders = [_Counts(block, 1), _Counts(block, 2)]
    keys, counts = _distinct(np.concatenate([o.keys for o in orders]))
    at = np.searchsorted(keys, _ALL)
    return np.insert(keys, at, _ALL), np.insert(counts, at, len(block.codes)), orders


def _send(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    return to_buckets(block, keys, buckets, counts=lambda s: pack(counts[s]))


def _send_pairs(table: pa.Table, buckets: int) -> pa.Table:
    block = Block(table)
    keys, counts, _ = _pairs_table(block)
    return _send(block.number, keys, counts, buckets)


def _add_up(table: pa.Table, kind: int) -> pa.Table:
    """Corpus counts of a bucket's n-grams, to each block in the order it sent them."""
    keys, bounds = unpack_all(table.column("keys"), unpack_sorted)
    counts, _ = unpack_all(table.column("counts"), kind=np.int64)
    order = np.argsort(keys, kind="stable")
    first = group_starts(keys[order])
    totals = np.empty(len(keys), np.int64)
    totals[order] = np.repeat(np.add.reduceat(counts[order], first), sizes_of(first, len(keys)))
    return pa.table({
        "block": table.column("block"), "bucket": table.column("bucket"), "kind": pa.array(np.full(table.num_rows, kind), pa.int32()),
        "counts": pa.array([pack(totals[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())})


def _totals(answers: pa.Table, kind: int) -> np.ndarray:
    """The answers of one kind in the order of the ascending codes: buckets own ascending ranges."""
    rows = sorted((b, c) for b, k, c in zip(*(answers.column(n).to_pylist() for n in ("bucket", "kind", "counts")), strict=True) if k == kind)
    return np.concatenate([unpack(c, np.int64) for _, c in rows]) if rows else np.zeros(0, np.int64)


class _Scored:
    """A block with the counts of the other documents: of all, of words, of pairs, and which triples can occur there."""

    def __init__(self, table: pa.Table, answers: pa.Table) -> None:
        self.block = block = Block(table)
        keys, _, (words, pairs) = _pairs_table(block)
        totals = _totals(answers, 0)
        self.all = totals[np.searchsorted(keys, _ALL)] - block.sizes
        self.words = words.spread(keys, totals) - words.own()
        self.pairs = np.zeros(len(block.codes), np.int64)
        self.pairs[pairs.at] = pairs.spread(keys, totals) - pairs.own()
        self.triples = _Counts(block, 3)
        at = self.triples.at
        self.open = np.flatnonzero((self.pairs[at] > 0) & (self.pairs[at + 1] > 0))


def _send_triples(table: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    s = _Scored(table, answers)
    keys, counts = _distinct(s.triples.keys[s.open])
    return _send(s.block.number, keys, counts, buckets)


def _score(table: pa.Table, answers: pa.Table, alpha: float) -> pa.Table:
    s = _Scored(table, answers)
    b, t = s.block, s.triples
    triples = np.zeros(len(b.codes), np.int64)
    keys, _ = _distinct(t.keys[s.open])
    own = t.own()
    triples[t.at[s.open]] = (t.spread(keys, _totals(answers, 1)) - own)[s.open]
    place = np.arange(len(b.codes)) - b.bounds[b.doc]
    # Counts at a position are of the n-gram that starts there; shift them to its last word.
    pair, triple, history = (np.zeros(len(b.codes)) for _ in range(3))
    pair[1:], history[1:] = s.pairs[:-1], s.words[:-1]
    triple[2:] = triples[:-2]
    pair_history = np.zeros(len(b.codes))
    pair_history[2:] = s.pairs[:-2]
    value = np.maximum(s.words, 0.5) / np.maximum(s.all, 1)[b.doc] * alpha ** np.minimum(place, 2)
    by_pair = (place >= 1) & (pair > 0)
    value[by_pair] = pair[by_pair] / history[by_pair] * np.where(place[by_pair] >= 2, alpha, 1.0)
    by_triple = (place >= 2) & (triple > 0)
    value[by_triple] = triple[by_triple] / pair_history[by_triple]
    sums = np.array([np.log(value[x:y]).sum() for x, y in zip(b.bounds[:-1], b.bounds[1:], strict=True)])
    mean = np.divide(sums, b.sizes, out=np.zeros(len(sums)), where=b.sizes > 0)
    return pa.table({"doc_id": b.table.column("doc_id"), "n_words": pa.array(b.sizes), "log_score": pa.array(sums),
                     "mean_score": pa.array(mean, mask=b.sizes == 0)})


def backoff_scores(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Per document: doc_id, n_words, log_score (sum over the words) and mean_score (NULL without words).

    A word is scored by the count of the longest n-gram that another row holds, over
    the count of its history; each step back costs ``alpha``; a word no other row holds
    counts one half.  NULL and empty texts have no words and log_score 0.  Repeated
    rows are other documents to one another.  An empty table gives an empty table.
    """
    blocks = in_blocks(docs.select("doc_id", "text"))
    buckets = buckets_for(docs.sparkSession)
    pairs = (blocks.groupBy("block_").applyInArrow(lambda t: _send_pairs(t, buckets), _SENT)
             .groupBy("bucket").applyInArrow(lambda t: _add_up(t, 0), _BACK))
    triples = (blocks.groupBy("block_").cogroup(pairs.groupBy("block"))
               .applyInArrow(lambda left, right: _send_triples(left, right, buckets), _SENT)
               .groupBy("bucket").applyInArrow(lambda t: _add_up(t, 1), _BACK))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("block_").cogroup(pairs.unionByName(triples).groupBy("block")).applyInArrow(
        lambda left, right: _score(left, right, alpha), f"doc_id {kind}, n_words long, log_score double, mean_score double")
