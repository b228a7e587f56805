"""Word n-grams as 64-bit codes, and the exchange of packed n-gram tables between blocks of documents.

Documents are dealt into blocks by a hash.  A block sends each different n-gram it
holds once, packed, to the bucket that owns the n-gram's hash range; a bucket answers
the blocks.  A frequent n-gram so costs one entry per block, not one per occurrence,
and an entry costs five to six bytes of shuffle instead of a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import buckets_for

#: Documents and bytes of text per block, on the average, and, at least, blocks per shuffle partition.
BLOCK_ROWS = 2000
BLOCK_BYTES = 16 * 2 ** 20
BLOCKS_PER_PARTITION = 1
#: Different words a Python worker remembers the codes of.
MOST_WORDS = 250_000
#: Takes the place of a NULL doc_id: larger than every id.
NO_ID = 2 ** 63 - 1

_ODD = np.random.default_rng(20240501).integers(0, 2 ** 63, (8, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordCodes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        code = self[word] = xxh3_64_intdigest(word)
        return code


_codes = _WordCodes()


def word_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of all texts in a row, and the bounds of each text; bytes.split() parts at [\\x20\\x09-\\x0D]."""
    parts = []
    for text in texts:
        words = text.split() if text else ()
        parts.append(np.fromiter(map(_codes.__getitem__, words), np.uint64, len(words)))
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_codes(codes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A code for each run of ``k`` words, whether or not it lies in one text."""
    n = max(0, len(codes) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out += codes[j:n + j] * _ODD[salt, j]
    return mix(out)


def inside(doc: np.ndarray, k: int) -> np.ndarray:
    """For each run of ``k`` words, whether it lies in one text; ``doc`` numbers the text of each word."""
    n = max(0, len(doc) - k + 1)
    return doc[:n] == doc[k - 1:n + k - 1]


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group starts in arrays sorted by ``keys``."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def sizes_of(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.r_[starts, n])


def pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers as compressed byte planes: the high bytes of small numbers cost next to nothing."""
    kind = np.int64 if values.dtype.kind == "i" else np.uint64
    return zstandard.compress(np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, 8).T), 1)


def unpack(data: bytes, kind: type = np.uint64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending codes by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def unpack_all(column: pa.ChunkedArray, read=unpack, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """All rows' numbers in a row, and each row's bounds."""
    parts = [read(x, kind) if read is unpack else read(x) for x in column.to_pylist()]
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), bounds


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the buckets in ascending codes: bucket b owns an equal range of codes."""
    firsts = [np.uint64(b * 2 ** 64 // buckets) for b in range(buckets)]
    return np.r_[np.searchsorted(keys, np.array(firsts, np.uint64)), len(keys)]


def to_buckets(block: int, keys: np.ndarray, buckets: int, **columns) -> pa.Table:
    """A row per bucket that gets anything; ``columns`` maps names to functions from a slice to bytes."""
    cut = bucket_bounds(keys, buckets)
    full = np.flatnonzero(np.diff(cut))
    rows = {"bucket": pa.array(full, pa.int32()), "block": pa.array(np.full(len(full), block), pa.int32()),
            "keys": pa.array([pack_sorted(keys[cut[b]:cut[b + 1]]) for b in full], pa.binary())}
    for name, of in columns.items():
        rows[name] = pa.array([of(slice(cut[b], cut[b + 1])) for b in full], pa.binary())
    return pa.table(rows)


def in_blocks(docs: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with block_ and key_: the block of the row, and its doc_id or NO_ID for NULL."""
    count, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(buckets_for(docs.sparkSession, BLOCKS_PER_PARTITION), math.ceil(count / rows), math.ceil(size / BLOCK_BYTES))
    return docs.withColumns({
        "block_": F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"),
        "key_": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))})


class Block:
    """The words of a block: documents by ascending id, codes of all their words."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("key_").to_numpy()
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        self.table = table.take(pa.array(self.order))
        self.texts = self.table.column("text").cast(pa.binary()).to_pylist()
        self.codes, self.bounds = word_codes(self.texts)
        self.sizes = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.ids)), self.sizes)
        self.number = table.column("block_")[0].as_py()
