"""SentencePiece BPE in vectorised merge rounds.

A text is cut into units, a run of spaces and what follows it up to the next space;
no piece of the vocabulary reaches over the start of a unit, so units are encoded
alone, each different unit once per task.  All open units lie in one flat array of
symbols.  Each round finds the best pair of every unit, merges its occurrences from
the left at once, and closes the gaps, until no pair is left.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
NO_RANK = np.int32(2 ** 31 - 1)
#: Bits for the right symbol in a pair's key: piece ids and code points fit.
KEY_BITS = 21
#: Characters encoded at once, and different units a task remembers.
CHUNK_CHARS = 4_000_000
MOST_UNITS = 500_000

_units = re.compile(" +[^ ]*").findall
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """The vocabulary as arrays: first symbols of characters, pair ranks, piece bytes."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        if sp.normalize(" ﬁ  a") != f"{SPACE * 2}ﬁ{SPACE * 2}a" or sum(map(sp.is_byte, range(n))) != 256:
            raise ValueError("needs a BPE model with byte pieces and no normalisation but the leading space")
        self.n, self.bos, self.eos = n, sp.bos_id(), sp.eos_id()
        normal, data, byte_ids = {}, [], np.zeros(256, np.int32)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                data.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i):
                data.append(b"")
            elif sp.is_unknown(i):
                data.append(" ⁇ ".encode())
            else:
                normal[piece] = i
                data.append(piece.replace(SPACE, " ").encode())
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("a piece holds a space after other characters; units can't be encoded alone")
        self.byte_ids = byte_ids
        self.spaced = np.zeros(n, bool)
        self.spaced[[i for piece, i in normal.items() if piece.startswith(SPACE)]] = True
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.length = np.array([len(x) for x in data], np.int64)
        self.start = np.cumsum(self.length) - self.length
        # Characters outside the vocabulary get symbols above it, which no pair holds.
        self.symbol = np.arange(0x110000, dtype=np.int64) + n
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.symbol[0x20] = self.symbol[ord(SPACE)]
        scores = np.array([sp.get_score(i) for i in normal.values()])
        ranks = dict(zip(normal, np.unique(-scores, return_inverse=True)[1].tolist(), strict=True))
        pairs = {}
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                left, right = normal.get(piece[:k]), normal.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << KEY_BITS | right] = (ranks[piece], i)
        self._build_table(pairs)

    def _build_table(self, pairs: dict) -> None:
        """A hash table with linear probing, sparse enough that most look-ups take one probe."""
        self.bits = max(10, (len(pairs) * 3).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NO_RANK, np.int32)
        self.merged = np.zeros(size, np.int64)
        for key, (rank, piece) in pairs.items():
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] != -1:
                at = (at + 1) % size
            self.keys[at], self.ranks[at], self.merged[at] = key, rank, piece

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_RANK for no piece) and merged piece of each pair of symbols."""
        keys = left << KEY_BITS | right
        at = self._slot(keys)
        found = self.keys[at]
        astray = np.flatnonzero((found != keys) & (found != -1))
        while len(astray):
            at[astray] = (at[astray] + 1) % len(self.keys)
            found = self.keys[at[astray]]
            astray = astray[(found != keys[astray]) & (found != -1)]
        return self.ranks[at], self.merged[at]

    def _pair_ranks(self, symbols: np.ndarray, unit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of the pairs that begin at ``at``; no rank at the end of a unit."""
        rank, merged = np.full(len(at), NO_RANK, np.int32), np.zeros(len(at), np.int64)
        after = np.minimum(at + 1, len(symbols) - 1)
        ok = np.flatnonzero((after > at) & (unit[after] == unit[at])) if len(at) else at
        rank[ok], merged[ok] = self.find(symbols[at[ok]], symbols[after[ok]])
        return rank, merged

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all units, one after the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        symbols = self.symbol[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        unit = np.repeat(np.arange(len(units)), lengths)
        rank, merged = self._pair_ranks(symbols, unit, np.arange(len(unit)))
        done_units, done_symbols = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(unit)]))
            if (over := best == NO_RANK).any():
                done_units.append(unit[over])
                done_symbols.append(symbols[over])
                symbols, unit, rank, merged, best = (x[~over] for x in (symbols, unit, rank, merged, best))
            at = self._chosen(np.flatnonzero(rank == best), symbols, unit, rank, merged)
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, unit, rank, merged = symbols[keep], unit[keep], rank[keep], merged[keep]
            # Only the pairs on either side of a new symbol change.
            at = at - np.arange(len(at))
            at = np.r_[at, at[at > 0] - 1]
            rank[at], merged[at] = self._pair_ranks(symbols, unit, at)
        if not done_units:
            return np.zeros(0, np.int64), np.zeros(len(units), np.int64)
        unit, symbols = np.concatenate(done_units), np.concatenate(done_symbols)
        order = np.argsort(unit, kind="stable")
        return self._bytes_for_unknown(symbols[order], unit[order], len(units))

    def _chosen(self, at: np.ndarray, symbols, unit, rank, merged) -> np.ndarray:
        """Occurrences to merge in this round: from the left, without overlaps.

        A merge can open a pair that ranks as high as the present one.  What follows
        such a merge in its unit waits for the next round, as merging one by one would.
        """
        if not len(at):
            return at
        run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        place = at - np.repeat(at[run], np.diff(np.r_[run, len(at)]))
        at = at[place % 2 == 0]
        owner = unit[at]
        several = np.zeros(len(at), bool)
        several[1:] = owner[1:] == owner[:-1]
        several[:-1] |= several[1:].copy()
        if not several.any():
            return at
        here = at[several]
        new = merged[here]
        last = len(symbols) - 1
        before = np.maximum(here - 1, 0)
        left = symbols[before].copy()
        touching = np.r_[False, np.diff(here) == 2]
        left[touching] = new[np.flatnonzero(touching) - 1]
        after = np.minimum(here + 2, last)
        worst = np.full(len(here), NO_RANK, np.int32)
        ok = (here > 0) & (unit[before] == unit[here])
        worst[ok] = self.find(left[ok], new[ok])[0]
        ok = (here + 2 <= last) & (unit[after] == unit[here])
        worst[ok] = np.minimum(worst[ok], self.find(new[ok], symbols[after][ok])[0])
        stops = np.cumsum(worst <= rank[here])
        owner = unit[here]
        first = np.r_[True, owner[1:] != owner[:-1]]
        earlier = np.r_[0, stops[:-1]]
        earlier = earlier - np.repeat(earlier[first], np.diff(np.r_[np.flatnonzero(first), len(here)]))
        keep = ~several
        keep[np.flatnonzero(several)[earlier == 0]] = True
        return at[keep]

    def _bytes_for_unknown(self, ids: np.ndarray, unit: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
        unknown = ids >= self.n
        if unknown.any():
            chars, which = np.unique(ids[unknown] - self.n, return_inverse=True)
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
            table = np.full((len(raw), 4), -1, np.int64)
            for k, x in enumerate(raw):
                table[k, : len(x)] = self.byte_ids[list(x)]
            rows = np.full((len(ids), 4), -1, np.int64)
            rows[:, 0] = ids
            rows[unknown] = table[which]
            unit = np.repeat(unit, (rows >= 0).sum(axis=1))
            ids = rows[rows >= 0]
        return ids, np.bincount(unit, minlength=units)

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all pieces in a row."""
        return self.data[_spans(self.start[ids], self.length[ids])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; the space that the first piece begins with is the model's own."""
        raw = self.decode_bytes(ids).tobytes()
        ids = ids[self.length[ids] > 0]
        return _whole(raw[1:] if len(ids) and self.spaced[ids[0]] else raw).decode()


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each span, one span after the other."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _whole(raw: bytes) -> bytes:
    """Piece bytes in UTF-8, each broken byte a replacement character."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "each_byte").encode()


class Numbers(dict):
    """Numbers units in the order they are first asked for."""

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        return n


class Encoder:
    """Encodes texts with the memory of one task: each different unit is encoded once."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.number = Numbers()
        self.ids = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the bounds of each text in them."""
        if len(self.number) > MOST_UNITS:
            self._forget()
        known, counts, each = len(self.number), [], []
        for text in texts:
            # The model's leading space is the first character of the first unit; keys go without it.
            text = text.replace(SPACE, " ")
            units = [] if not text else (
                [x[1:] for x in _units(" " + text)] if "  " in text or text[0] == " " else text.split(" "))
            counts.append(len(units))
            each.append(np.fromiter(map(self.number.__getitem__, units), np.int64, len(units)))
        if pending := list(itertools.islice(reversed(self.number), len(self.number) - known)):
            ids, sizes = self.pieces.encode_units([" " + u for u in reversed(pending)])
            self.start = np.r_[self.start, np.cumsum(sizes) - sizes + len(self.ids)]
            self.ids, self.size = np.r_[self.ids, ids], np.r_[self.size, sizes]
        each = np.concatenate(each) if each else np.zeros(0, np.int64)
        sizes = self.size[each]
        bounds = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(np.array(counts, np.int64))]]
        return self.ids[_spans(self.start[each], sizes)], bounds


@functools.lru_cache(maxsize=2)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def chunks(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with at most CHUNK_CHARS bytes of text (one row at least), and their texts; NULL is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        size = np.asarray(pc.fill_null(pc.binary_length(column), 0))
        at = 0
        while at < len(column):
            run = np.cumsum(size[at:])
            to = at + max(1, int(np.searchsorted(run, CHUNK_CHARS, side="right")))
            yield batch.slice(at, to - at), [
                (x or b"").decode("utf-8", "replace") for x in column.slice(at, to - at).to_pylist()]
            at = to


def digest_texts(model: bytes, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(_pieces(model))
    p = encoder.pieces
    bos, eos = np.array([p.bos], "<u4").tobytes(), np.array([p.eos], "<u4").tobytes()
    for part, texts in chunks(batches, "text"):
        ids, bounds = encoder.encode(texts)
        packed = ids.astype("<u4")
        raw = p.decode_bytes(ids)
        ends = np.r_[0, np.cumsum(p.length[ids])][bounds]
        id_hash, text_hash = [], []
        for k in range(len(texts)):
            id_hash.append(hashlib.sha256(bos + packed[bounds[k]:bounds[k + 1]].tobytes() + eos).hexdigest())
            # The first unit begins with the model's own space.
            text_hash.append(hashlib.sha256(_whole(raw[ends[k] + 1:ends[k + 1]].tobytes())).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(bounds) + 2), pa.array(id_hash), pa.array(text_hash)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens with begin and end ids, and digests of the ids and of their decoded text.

    NULL and empty texts have the begin and the end id only.  Rows are independent:
    repeated rows give equal rows, an empty table an empty one; a long text or word
    is encoded whole.  The model file is read once on the driver and sent along.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: digest_texts(model, batches),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """All columns of ``docs`` and ``ids``, the token ids with begin and end; a column of that name is replaced."""
    docs = docs.drop("ids")
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_pieces(model))
        for part, texts in chunks(batches, "text"):
            ids, bounds = encoder.encode(texts)
            lists = [[encoder.pieces.bos, *ids[a:b].tolist(), encoder.pieces.eos] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*part.schema.names, "ids"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Replace a column of token ids by ``text``, the decoded text; NULL ids decode to an empty text."""
    with open(model_path, "rb") as f:
        model = f.read()
    kept = [c for c in rows.columns if c not in (ids, "text")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids_")).to_pylist()
            texts = [p.decode(np.array(x or [], np.int64)) for x in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField("text", T.StringType())])
    return rows.select(*kept, F.col(ids).alias("ids_")).mapInArrow(run, schema)
