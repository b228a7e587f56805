"""Remove word runs that an earlier document already holds, by De Bruijn edges and source coordinates.

Every window of WINDOW words is an edge between its first and its last WINDOW - 1
words.  Edges that only one document holds cannot repeat and are dropped; for that,
blocks of documents first exchange the windows' minimisers (the smallest code of a
shorter run inside), then only the windows with a repeated minimiser.  The join on
the edge gives each repeated edge its source coordinate: the smallest document that
holds it, and the place in it.  Edges that follow one another in a document and whose
source coordinates do so as well form a path without a branch, which compacts to one
span; a span ends where the source changes.  A window counts as repeated only if two
independent 64-bit codes agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import apart, buckets_for
from .grams import (
    Block,
    gram_codes,
    group_starts,
    in_blocks,
    inside,
    mix,
    pack,
    pack_sorted,
    sizes_of,
    to_buckets,
    unpack_all,
    unpack_sorted,
)

WINDOW = 13
#: Length of the run a window's minimiser is taken from.
SEED = 7

_SEEDS = "bucket int, block int, keys binary, shared binary"
_SEEDS_BACK = "block int, seeds binary, keys binary, check binary, docs binary, places binary"
_EDGES = "bucket int, block int, keys binary, check binary, docs binary, places binary, shared binary"


def _bits(flags: np.ndarray) -> bytes:
    return flags.astype(np.uint8).tobytes()


def _minimisers(block: Block, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and the code of each one's minimiser."""
    starts = np.flatnonzero(inside(block.doc, window))
    short = gram_codes(block.codes, seed, salt=2)
    n = max(0, len(block.codes) - window + 1)
    least = short[:n].copy()
    for j in range(1, window - seed + 1):
        np.minimum(least, short[j:n + j], out=least)
    return starts, mix(least[starts])


def _runs(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return group_starts(codes, doc)


def _send_seeds(table: pa.Table, window: int, seed: int, buckets: int) -> pa.Table:
    block = Block(table)
    starts, codes = _minimisers(block, window, seed)
    doc = block.doc[starts]
    first = _runs(codes, doc)
    codes, doc = codes[first], doc[first]
    order = np.argsort(codes, kind="stable")
    codes, doc = codes[order], doc[order]
    first = group_starts(codes)
    last = first + sizes_of(first, len(codes)) - 1
    shared = block.ids[doc[first]] != block.ids[doc[last]]
    return to_buckets(block.number, codes[first], buckets, shared=lambda s: _bits(shared[s]))


def _answer_seeds(table: pa.Table) -> pa.Table:
    """The minimisers of each block that another block, or another document of the block, holds too."""
    keys, bounds = unpack_all(table.column("keys"), unpack_sorted)
    shared = np.frombuffer(b"".join(table.column("shared").to_pylist()), np.uint8).astype(bool)
    order = np.argsort(keys, kind="stable")
    first = group_starts(keys[order])
    size = sizes_of(first, len(keys))
    again = np.empty(len(keys), bool)
    again[order] = np.repeat((size > 1) | np.logical_or.reduceat(shared[order], first), size)
    rows = [(b, keys[x:y][again[x:y]]) for b, x, y in zip(table.column("block").to_pylist(), bounds[:-1], bounds[1:], strict=True)]
    rows = [(b, k) for b, k in rows if len(k)]
    empty = pa.array([b""] * len(rows), pa.binary())
    return pa.table({"block": pa.array([b for b, _ in rows], pa.int32()), "seeds": pa.array([pack_sorted(k) for _, k in rows], pa.binary()),
                     "keys": empty, "check": empty, "docs": empty, "places": empty})


def _among(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted ones, and where."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys, at


def _send_edges(table: pa.Table, answers: pa.Table, window: int, seed: int, buckets: int) -> pa.Table:
    if not table.num_rows or not answers.num_rows:
        return to_buckets(0, np.zeros(0, np.uint64), buckets, check=bytes, docs=bytes, places=bytes, shared=bytes)
    block = Block(table)
    starts, codes = _minimisers(block, window, seed)
    first = _runs(codes, block.doc[starts])
    hit, _ = _among(np.sort(unpack_all(answers.column("seeds"), unpack_sorted)[0]), codes[first])
    starts = starts[np.repeat(hit, sizes_of(first, len(codes)))]
    keys, check = (gram_codes(block.codes, window, salt)[starts] for salt in (0, 1))
    # Starts ascend by document id and place, so the first of a group is its source in this block.
    order = np.argsort(keys, kind="stable")
    keys, check, starts = keys[order], check[order], starts[order]
    first = group_starts(keys, check)
    doc = block.doc[starts]
    last = first + sizes_of(first, len(keys)) - 1
    shared = block.ids[doc[first]] != block.ids[doc[last]]
    source, place = block.ids[doc[first]], (starts - block.bounds[doc])[first]
    check = check[first]
    return to_buckets(
        block.number, keys[first], buckets, check=lambda s: check[s].tobytes(), docs=lambda s: pack(source[s]),
        places=lambda s: pack(place[s]), shared=lambda s: _bits(shared[s]))


def _answer_edges(table: pa.Table) -> pa.Table:
    """The source coordinates of each block's repeated edges, where the block holds a later document."""
    keys, bounds = unpack_all(table.column("keys"), unpack_sorted)
    check = np.frombuffer(b"".join(table.column("check").to_pylist()), np.uint64)
    docs, places = (unpack_all(table.column(c), kind=np.int64)[0] for c in ("docs", "places"))
    shared = np.frombuffer(b"".join(table.column("shared").to_pylist()), np.uint8).astype(bool)
    order = np.lexsort((places, docs, check, keys))
    first = group_starts(keys[order], check[order])
    size = sizes_of(first, len(keys))
    source, place = np.empty_like(docs), np.empty_like(places)
    source[order] = np.repeat(docs[order][first], size)
    place[order] = np.repeat(places[order][first], size)
    later = (source < docs) | shared
    rows = []
    for b, x, y in zip(table.column("block").to_pylist(), bounds[:-1], bounds[1:], strict=True):
        at = x + np.flatnonzero(later[x:y])
        if len(at):
            rows.append((b, b"", pack_sorted(keys[at]), (check[at] & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), pack(source[at]), pack(place[at])))
    names = ["block", "seeds", "keys", "check", "docs", "places"]
    return pa.table({n: pa.array([r[i] for r in rows], pa.int32() if n == "block" else pa.binary()) for i, n in enumerate(names)})


class _Repeats:
    """What a block's documents repeat: spans, and the words they cover."""

    def __init__(self, table: pa.Table, answers: pa.Table, window: int) -> None:
        self.block = block = Block(table)
        keys, _ = unpack_all(answers.column("keys"), unpack_sorted)
        check = np.frombuffer(b"".join(answers.column("check").to_pylist()), np.uint16)
        docs, places = (unpack_all(answers.column(c), kind=np.int64)[0] for c in ("docs", "places"))
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(inside(block.doc, window))
        hit, at = _among(keys[order], gram_codes(block.codes, window, 0)[starts])
        starts, at = starts[hit], order[at[hit]] if len(order) else at[hit]
        same = (gram_codes(block.codes, window, 1)[starts] & np.uint64(0xFFFF)) == check[at]
        earlier = same & (docs[at] < block.ids[block.doc[starts]])
        starts, source, place = starts[earlier], docs[at][earlier], places[at][earlier]
        # One path while document, source document and the distance between the two places stay and the start moves by one.
        doc = block.doc[starts]
        self.first = group_starts(doc, source, place - starts, starts - np.arange(len(starts)))
        words = sizes_of(self.first, len(starts)) + window - 1
        self.doc, self.length = doc[self.first], words
        self.start = starts[self.first]
        self.source, self.place = source[self.first], place[self.first]
        edge = np.zeros(len(block.codes) + 1, np.int64)
        np.add.at(edge, self.start, 1)
        np.add.at(edge, self.start + words, -1)
        self.covered = np.cumsum(edge[:-1]) > 0


def _kept(text: bytes | None, covered: np.ndarray) -> bytes:
    words = text.split() if text else []
    return b" ".join([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone] if covered.any() else words)


def _report(table: pa.Table, answers: pa.Table, window: int) -> pa.Table:
    if not table.num_rows:
        return pa.table({"doc_id": pa.array([], table.schema.field("doc_id").type), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                         "kept_sha256": pa.array([], pa.string()), "n_spans": pa.array([], pa.int64())})
    r = _Repeats(table, answers, window)
    b = r.block
    cover = [r.covered[x:y] for x, y in zip(b.bounds[:-1], b.bounds[1:], strict=True)]
    return pa.table({
        "doc_id": b.table.column("doc_id"), "n_words": pa.array(b.sizes), "n_removed": pa.array([int(c.sum()) for c in cover], pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(_kept(t, c)).hexdigest() for t, c in zip(b.texts, cover, strict=True)], pa.string()),
        "n_spans": pa.array(np.bincount(r.doc, minlength=len(b.ids)), pa.int64())})


def _spans(table: pa.Table, answers: pa.Table, window: int) -> pa.Table:
    names = ["start", "length", "source_doc", "source_start"]
    if not table.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), **{n: pa.array([], pa.int64()) for n in names}})
    r = _Repeats(table, answers, window)
    return pa.table({"doc_id": pa.array(r.block.ids[r.doc]), "start": pa.array(r.start - r.block.bounds[r.doc]), "length": pa.array(r.length),
                     "source_doc": pa.array(r.source), "source_start": pa.array(r.place)})


def _cut(table: pa.Table, answers: pa.Table, window: int, names: list[str]) -> pa.Table:
    if not table.num_rows:
        return table.select(names)
    r = _Repeats(table, answers, window)
    b = r.block
    cover = [r.covered[x:y] for x, y in zip(b.bounds[:-1], b.bounds[1:], strict=True)]
    field = table.schema.field("text")
    texts = pa.array([_kept(t, c) if c.any() else t for t, c in zip(b.texts, cover, strict=True)], pa.binary()).cast(pa.string()).cast(field.type)
    out = b.table.select(names).set_column(names.index("text"), field, texts)
    if "n_chars" in names:
        n = pc.utf8_length(texts).cast(table.schema.field("n_chars").type)
        changed = pa.array([bool(c.any()) for c in cover])
        at = names.index("n_chars")
        out = out.set_column(at, table.schema.field("n_chars"), pc.if_else(changed, n, out.column(at).combine_chunks()))
    return out


def _answers(blocks: DataFrame, window: int, seed: int) -> DataFrame:
    if not 0 < seed <= window <= 64:
        raise ValueError("needs 0 < seed <= window <= 64")
    buckets = buckets_for(blocks.sparkSession)
    seeds = (blocks.groupBy("block_").applyInArrow(lambda t: _send_seeds(t, window, seed, buckets), _SEEDS)
             .groupBy("bucket").applyInArrow(_answer_seeds, _SEEDS_BACK))
    edges = blocks.groupBy("block_").cogroup(seeds.groupBy("block")).applyInArrow(
        lambda left, right: _send_edges(left, right, window, seed, buckets), _EDGES)
    return edges.groupBy("bucket").applyInArrow(_answer_edges, _SEEDS_BACK)


def _per_block(docs: DataFrame, window: int, seed: int, run, schema) -> DataFrame:
    blocks = in_blocks(docs)
    answers = _answers(blocks, window, seed)
    return blocks.groupBy("block_").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def dedup_report(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and n_spans.

    A word goes if a window that covers it also starts in a document with a smaller
    id.  NULL and empty texts have no words; a NULL id counts as larger than every
    id and rows with one id never remove each other's words, so copies under one id
    stay.  Texts shorter than a window stay whole; an empty table gives an empty table.
    """
    rows = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _per_block(rows, window, seed, lambda left, right: _report(left, right, window),
                      f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, n_spans long")


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The spans themselves: doc_id, start, length, and where the source document holds the same words."""
    return _per_block(docs.select("doc_id", "text"), window, seed, lambda left, right: _spans(left, right, window),
                      "doc_id long, start long, length long, source_doc long, source_start long")


@apart("doc_id", "text", "n_chars")
def cut_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs`` without the repeated words; a text that loses words is its kept words joined by a space, n_chars follows."""
    names = docs.columns
    return _per_block(docs, window, seed, lambda left, right: _cut(left, right, window, names), T.StructType(docs.schema.fields))
