"""Which tokens of two tokenizers stand for the same bytes, and how many documents hold each pair.

Both tokenizers cut the same bytes.  Where tokens of both end at one offset a group
ends, and all tokens of a group are linked.  The pairs are counted over the corpus by
external sorting:

1. A task collects pair-document records until a bound, sorts them by side A, and
   spills one zstd run per radix bucket of the A id: each pair once, with the number of
   the run's documents that hold it.  Runs are rows of a table in the shared folder.
2. A bucket merges its runs with a heap, one A id after another: that counts each pair,
   gives the maximum of the A id, and both go back to the runs in their own order.
3. A block, the documents of one spill, adds up what its documents' pairs get.

So a pair that all documents hold is one entry a run, and no task sees all its records.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import buckets_for, stored
from .grams import group_starts, pack, pack_sorted, sizes_of, unpack, unpack_sorted

SPACE = "▁"
#: Pair-document records, and documents, that a task collects before it spills.
MOST_RECORDS = 2_000_000
MOST_DOCUMENTS = 20_000
#: Bytes of text encoded at once, by whole texts, and links written out at once.
CHUNK_BYTES = 2_000_000
MOST_LINKS = 4_000_000
#: Groups of more links are reduced to different ids before they are written out.
LARGE_GROUP = 4096
#: Bits of an id; the A id goes first.
ID_BITS = 20

# How byte-level vocabularies write bytes, and how they cut text.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Tokens:
    """The bytes of all tokens of one tokenizer, their lengths, and their ids as text before ',', the group's end, or the side's end."""

    def __init__(self, data: list[bytes], ends: bytes) -> None:
        self.n, self.data = len(data), data
        self.length = np.array([len(x) for x in data], np.int64)
        self.text = [b"%d%c" % (i, e) for e in ends for i in range(self.n)]


class ByteBpe(_Tokens):
    """A byte-level BPE from a ``tokenizer.json``, encoded by tiktoken; special tokens are left out."""

    def __init__(self, spec: bytes) -> None:
        import tiktoken

        whole = json.loads(spec)
        model, own = whole["model"], {t["content"] for t in whole["added_tokens"] if t["special"]}
        before = whole["pre_tokenizer"]
        plain = model["type"] == "BPE" and not model.get("ignore_merges") and whole["normalizer"] is None
        if not plain or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError("needs a byte-level BPE without normaliser and prefix space")
        byte_of = {chr(b): b for b in _PRINTED} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}
        vocab = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in own}
        # Merges in the order of their results' ids: then ids are ranks.
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(set(made)):
            raise ValueError("merges are not in the order of ids")
        data = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            data[i] = token
        super().__init__(data, b",|")
        self.encoding = tiktoken.Encoding("byte_level", pat_str=_BYTE_LEVEL_PATTERN, mergeable_ranks=vocab, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceBpe(_Tokens):
    """A sentencepiece model, encoded by its library, which adds the leading space."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = sp = SentencePieceProcessor(model_proto=model)
        data = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            byte = bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else None
            data.append(piece.replace(SPACE, " ").encode() if byte is None else byte)
        super().__init__(data, b",;")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@functools.lru_cache(1)
def _tokenizers(a_spec: bytes, b_model: bytes) -> tuple[ByteBpe, PieceBpe]:
    return ByteBpe(a_spec), PieceBpe(b_model)


@functools.lru_cache(4)
def _radix(n: int) -> np.ndarray:
    """A fixed shuffle of the A ids, so that their ranges are buckets of like size; frequent ids are small ones."""
    return np.random.default_rng(13).permutation(n)


class Aligned:
    """Texts of a chunk in both tokenizers.

    Flat ids of both sides, the group of each token, and each text's bounds in tokens
    and groups.  Texts that a side does not give back byte for byte have no tokens.
    """

    def __init__(self, a: ByteBpe, b: PieceBpe, texts: list[str | None]) -> None:
        self.a, self.b = a, b
        full = [t or "" for t in texts]
        a_ids, b_ids = a.encode(full), b.encode(full)
        for k, t in enumerate(full):
            want = b" " + t.encode()
            if not t or b"".join(map(a.data.__getitem__, a_ids[k])) != want or b"".join(map(b.data.__getitem__, b_ids[k])) != want:
                a_ids[k] = b_ids[k] = []
        self.a_ids, self.a_cut = _flat(a_ids)
        self.b_ids, self.b_cut = _flat(b_ids)
        a_end, b_end = np.cumsum(a.length[self.a_ids]), np.cumsum(b.length[self.b_ids])
        size = int(a_end[-1]) if len(a_end) else 0
        both = np.zeros(size + 1, np.int8)
        both[a_end] = 1
        both[b_end] += 1
        ended = np.cumsum(both == 2, dtype=np.int64)
        self.a_group, self.b_group = ended[a_end - 1], ended[b_end - 1]
        n = int(ended[-1])
        self.a_many, self.b_many = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        # Where a text's tokens end, its last group does.
        self.cut = np.r_[0, np.cumsum(self.a_many)].searchsorted(self.a_cut)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.cut))

    def links(self) -> np.ndarray:
        return np.bincount(self.doc, self.a_many * self.b_many, minlength=len(self.cut) - 1).astype(np.int64)

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2``, or an empty text for a text without tokens."""
        a_first, b_first = np.cumsum(self.a_many) - self.a_many, np.cumsum(self.b_many) - self.b_many
        a_at = np.arange(len(self.a_ids)) + b_first[self.a_group]
        b_at = np.arange(len(self.b_ids)) + (a_first + self.a_many)[self.b_group]
        # Texts with a separator: the second half of each list has the one that ends the side.
        code = np.empty(len(a_at) + len(b_at), np.int64)
        a_last = np.r_[self.a_group[1:] != self.a_group[:-1], True][:len(self.a_ids)]
        b_last = np.r_[self.b_group[1:] != self.b_group[:-1], True][:len(self.b_ids)]
        code[a_at] = self.a_ids + self.a.n * a_last
        code[b_at] = 2 * self.a.n + self.b_ids + self.b.n * b_last
        text = [*self.a.text, *self.b.text] if not hasattr(self.a, "both") else self.a.both
        self.a.both = text
        out, cut = [], self.a_cut + self.b_cut
        for k in range(len(cut) - 1):
            own = b"".join(map(text.__getitem__, code[cut[k]:cut[k + 1]].tolist()))
            out.append(hashlib.sha256(own[:-1]).hexdigest() if own else "")
        return out

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of each text's different pairs, by text and pair; a pair has the shuffled A id above the B id."""
        radix = _radix(self.a.n)
        parts = []
        large = self.a_many * self.b_many > LARGE_GROUP
        keep_a, keep_b = ~large[self.a_group], ~large[self.b_group]
        parts += self._pairs(self.a_group[keep_a], radix[self.a_ids[keep_a]], None, self.b_group[keep_b], self.b_ids[keep_b], None)
        if large.any():
            one = _counted(self.a_group[~keep_a], radix[self.a_ids[~keep_a]])
            two = _counted(self.b_group[~keep_b], self.b_ids[~keep_b])
            parts += self._pairs(*one, *two)
        return _summed(*[np.concatenate(x) for x in zip(*parts, strict=True)]) if parts else (np.zeros(0, np.int64),) * 3

    def _pairs(self, a_group, a_id, a_times, b_group, b_id, b_times) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Records of all pairs within groups, a bounded number of links at once; sides are ordered by group."""
        first = np.searchsorted(b_group, a_group)
        many = np.searchsorted(b_group, a_group, "right") - first
        upto = np.cumsum(many)
        out, at = [], 0
        while at < len(a_group):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + MOST_LINKS, "right")))
            n = many[at:to]
            partner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:to], n)
            times = np.ones(len(partner), np.int64) if a_times is None else np.repeat(a_times[at:to], n) * b_times[partner]
            out.append(_summed(np.repeat(self.doc[a_group[at:to]], n), np.repeat(a_id[at:to] << ID_BITS, n) | b_id[partner], times))
            at = to
        return out


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    cut = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=cut[1:])
    flat = np.empty(cut[-1], np.int64)
    for k, x in enumerate(lists):
        flat[cut[k]:cut[k + 1]] = x
    return flat, cut


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _summed(group, ids, np.ones(len(ids), np.int64))


def _summed(major: np.ndarray, minor: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (major, minor) in order, with their sums."""
    order = np.lexsort((minor, major))
    major, minor = major[order], minor[order]
    start = group_starts(major, minor)
    return major[start], minor[start], (np.add.reduceat(n[order], start) if len(start) else n)


class _Block:
    """Collects documents and their pair records, and gives out their rows and the runs of a spill."""

    def __init__(self, buckets: int, a_ids: int) -> None:
        self.buckets, self.a_ids = buckets, a_ids
        self.clear()

    def clear(self) -> None:
        self.documents, self.records, self.size, self.many = [], [], 0, 0

    def add(self, rows: pa.RecordBatch, records: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.documents.append(rows)
        self.records.append((records[0] + self.many, *records[1:]))
        self.many += rows.num_rows
        self.size += len(records[0])

    def spill(self, block: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        doc, pair, links = (np.concatenate(x) for x in zip(*self.records, strict=True))
        keys, place, held = np.unique(pair, return_inverse=True, return_counts=True)
        cut = np.searchsorted(doc, np.arange(self.many + 1))
        squeeze = zstandard.ZstdCompressor(1).compress
        bounds = zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)
        pairs = [squeeze(np.diff(place[i:j], prepend=0).astype("<u4").tobytes() + links[i:j].astype("<u4").tobytes()) for i, j in bounds]
        rows = pa.Table.from_batches(self.documents).combine_chunks().to_batches()[0]
        yield _rows(schema, rows.num_rows, block=np.full(rows.num_rows, block), pairs=pairs, **dict(zip(rows.schema.names, rows.columns, strict=True)))
        # Equal ranges of the shuffled A ids.
        edge = np.searchsorted(keys, (np.arange(self.buckets + 1) * self.a_ids + self.buckets - 1) // self.buckets << ID_BITS)
        full = np.flatnonzero(np.diff(edge))
        if len(full):
            yield _rows(schema, len(full), block=np.full(len(full), block), bucket=pa.array(full, pa.int32()),
                        keys=[pack_sorted(keys[edge[b]:edge[b + 1]].astype(np.uint64)) for b in full],
                        held=[pack(held[edge[b]:edge[b + 1]]) for b in full])
        self.clear()


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x := columns.get(f.name), pa.Array) else pa.nulls(n, f.type) if x is None else pa.array(x, f.type) for f in schema], schema=schema)


#: What a document has besides its id before pairs are counted.
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _document_rows(ids: pa.Array, chunk: Aligned) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(chunk.a_cut)), pa.array(np.diff(chunk.b_cut)), pa.array(np.diff(chunk.cut)), pa.array(chunk.links()), pa.array(chunk.digests())],
        names=["doc_id", *_COUNTS, "groups_sha256"])


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        at = size = 0
        for k, text in enumerate(texts):
            size += 4 * len(text or "")
            if size >= CHUNK_BYTES * 2 or k + 1 == len(texts):
                yield batch.column(0).slice(at, k + 1 - at), texts[at:k + 1]
                at, size = k + 1, 0


def _spilled(docs: DataFrame, a_spec: bytes, b_model: bytes, buckets: int, most_records: int, most_documents: int) -> DataFrame:
    """The table of documents (``bucket`` NULL) and runs, written once: tasks that run again write their blocks anew, whole."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_id", id_type), *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("bucket", T.IntegerType()),
        T.StructField("keys", T.BinaryType()), T.StructField("held", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(a_spec, b_model)
        block, number, arrow = _Block(buckets, a.n), TaskContext.get().partitionId() << 32, None
        for ids, texts in _chunks(batches):
            arrow = arrow or pa.schema([("block", pa.int64()), ("doc_id", ids.type), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string()),
                                        ("pairs", pa.binary()), ("bucket", pa.int32()), ("keys", pa.binary()), ("held", pa.binary())])
            chunk = Aligned(a, b, texts)
            block.add(_document_rows(ids, chunk), chunk.records())
            if block.size >= most_records or block.many >= most_documents:
                yield from block.spill(number, arrow)
                number += 1
        if block.many:
            yield from block.spill(number, arrow)

    return stored(docs.select("doc_id", "text").mapInArrow(run, schema), "token-pairs")


def merge_runs(keys: list[np.ndarray], held: list[np.ndarray]) -> list[np.ndarray]:
    """For each run, in its order, twice the pair's count over all runs, and one more where that is its A id's highest."""
    sides = [k >> np.uint64(ID_BITS) for k in keys]
    starts = [group_starts(s) for s in sides]
    out = [np.empty(len(k), np.int64) for k in keys]
    heap = [(int(s[0]), r, 0) for r, s in enumerate(sides) if len(s)]
    heapq.heapify(heap)
    while heap:
        side, members = heap[0][0], []
        while heap and heap[0][0] == side:
            _, r, k = heap[0]
            at = starts[r]
            end = at[k + 1] if k + 1 < len(at) else len(keys[r])
            members.append((r, at[k], end))
            if k + 1 < len(at):
                heapq.heapreplace(heap, (int(sides[r][end]), r, k + 1))
            else:
                heapq.heappop(heap)
        if len(members) == 1:
            (r, i, j), = members
            out[r][i:j] = 2 * held[r][i:j] + (held[r][i:j] == held[r][i:j].max())
            continue
        _, pair = np.unique(np.concatenate([keys[r][i:j] for r, i, j in members]), return_inverse=True)
        total = np.bincount(pair, np.concatenate([held[r][i:j] for r, i, j in members])).astype(np.int64)
        answer = (2 * total + (total == total.max()))[pair]
        at = 0
        for r, i, j in members:
            out[r][i:j] = answer[at:at + j - i]
            at += j - i
    return out


def _merge_bucket(table: pa.Table) -> pa.Table:
    keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
    held = [unpack(x, np.int64) for x in table.column("held").to_pylist()]
    answers = merge_runs(keys, held)
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "answers": pa.array([pack(x) for x in answers], pa.binary())})


def _score_block(documents: pa.Table, answers: pa.Table) -> pa.Table:
    by_bucket = np.argsort(answers.column("bucket").to_numpy())
    packed = answers.column("answers").to_pylist()
    value = np.concatenate([np.zeros(0, np.int64), *[unpack(packed[k], np.int64) for k in by_bucket.tolist()]])
    best, total = [], []
    expand = zstandard.ZstdDecompressor().decompress
    for x in documents.column("pairs").to_pylist():
        steps, links = np.frombuffer(expand(x), "<u4").astype(np.int64).reshape(2, -1)
        own = value[np.cumsum(steps)]
        best.append(int(links[own & 1 == 1].sum()))
        total.append(int((links * (own >> 1)).sum()))
    kept = documents.select(["doc_id", *_COUNTS])
    return pa.table([*kept.columns, pa.array(best, pa.int64()), pa.array(total, pa.int64()), documents.column("groups_sha256")],
                    names=[*kept.schema.names, "n_best", "count_sum", "groups_sha256"])


def alignment_report(docs: DataFrame, a_path: str, b_path: str, buckets: int | None = None, most_records: int = MOST_RECORDS,
                     most_documents: int = MOST_DOCUMENTS) -> DataFrame:
    """Per document the tokens, groups and links of both tokenizers, and how frequent its linked pairs are in the corpus.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is held by as
    many documents as any pair of its A id), count_sum (documents that hold the pair,
    summed over links) and groups_sha256.  Every row is a document, repeated rows too.
    NULL and empty texts, and texts a tokenizer does not give back byte for byte (those
    with U+2581), have zeros and an empty digest.  Ties for the highest count all count.
    An empty table gives an empty one.  The files at ``a_path`` (a byte-level BPE) and
    ``b_path`` (a sentencepiece model) are read once on the driver.
    """
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        a_spec, b_model = f.read(), g.read()
    buckets = buckets or buckets_for(docs.sparkSession)
    spilled = _spilled(docs, a_spec, b_model, buckets, most_records, most_documents)
    runs = spilled.filter(F.col("bucket").isNotNull()).select("block", "bucket", "keys", "held")
    answers = runs.groupBy("bucket").applyInArrow(_merge_bucket, "block long, bucket int, answers binary")
    documents = spilled.filter(F.col("bucket").isNull()).select("block", "doc_id", *_COUNTS, "groups_sha256", "pairs")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_block, f"doc_id {id_type}, {', '.join(c + ' long' for c in _COUNTS)}, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``docs`` with ``groups``: per group the A ids and the B ids, in order; a column of that name is replaced.

    Texts without tokens have no groups.
    """
    docs = docs.drop("groups")
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        a_spec, b_model = f.read(), g.read()
    ids = T.ArrayType(T.IntegerType())
    group = T.ArrayType(T.StructType([T.StructField("a", ids), T.StructField("b", ids)]))
    text_at = docs.columns.index("text")
    lists = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(a_spec, b_model)
        for batch in batches:
            out = []
            for text in batch.column(text_at).to_pylist():
                one = Aligned(a, b, [text])
                a_parts, b_parts = np.split(one.a_ids, np.cumsum(one.a_many)[:-1]), np.split(one.b_ids, np.cumsum(one.b_many)[:-1])
                out.append([{"a": x.tolist(), "b": y.tolist()} for x, y in zip(a_parts, b_parts, strict=True)] if len(one.doc) else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, lists)], names=[*batch.schema.names, "groups"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("groups", group)]))
