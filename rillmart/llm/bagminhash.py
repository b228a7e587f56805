"""Near-duplicate documents by BagMinHash signatures of word-shingle multisets.

Each shingle with its number of occurrences w owns the weight range [0, w), cut into
[0, 1), [1, 2), [2, 4), [4, 8) ...  Every range has a Poisson process of its own whose
rate is its width; a point carries a time, a register and a place in the range, and
counts if the place lies below w.  A register keeps the earliest time, and a process
stops once its time passes the latest register of its document, so a signature takes
few points however large the weights are.  Two signatures agree in a register with the
probability of the weighted Jaccard similarity of the two multisets.

Bands of registers deal texts into buckets.  Every text is compared with the pivot of
each of its buckets, the text that shares most bands with others: in a family of copies
that is the original or close to it.  What a text lacks of its pivot and has beyond it is
kept as two short bit sketches.  They bound the overlap of any two texts of one pivot from
above, so of the pairs that are still in different classes only those that can reach the
threshold are ever formed and verified; no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, stored
from .components import components
from .grams import gram_codes, group_starts, mix, pack_sorted, sizes_of, unpack_sorted, word_codes

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 128
BAND_ROWS = 4
#: Bits of the sketches, in 64-bit words.
SKETCH_WORDS = 8
#: Shingles sketched at once.
CHUNK = 400_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def shingle_bags(texts: list[bytes | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each text's shingles, sorted within the text, and the bounds; a shorter text is one shingle."""
    codes, bounds = word_codes(texts)
    sizes = np.diff(bounds)
    whole = gram_codes(codes, k)
    parts = []
    for a, n in zip(bounds[:-1].tolist(), sizes.tolist(), strict=True):
        if n >= k:
            parts.append(np.sort(whole[a:a + n - k + 1]))
        else:
            parts.append(gram_codes(codes[a:a + n], n) if n else np.zeros(0, np.uint64))
    out = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), out


def weighted(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text: code, text number, occurrences."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = group_starts(shingles, doc)
    return shingles[first], doc[first], sizes_of(first, len(shingles))


def bag_signatures(code: np.ndarray, doc: np.ndarray, weight: np.ndarray, docs: int, m: int = REGISTERS) -> np.ndarray:
    """(docs, m) earliest times; infinite for a text without shingles."""
    # One process per dyadic range that begins below the weight.
    ranges = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    at = np.repeat(np.arange(len(code)), ranges)
    level = np.arange(len(at)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(low, 1)
    limit = weight[at] - low
    owner = doc[at]
    state = mix(code[at] + level.astype(np.uint64) * _OTHER)
    time = np.zeros(len(at))
    registers = np.full(docs * m, np.inf)
    latest = np.full(docs, np.inf)
    while len(at):
        state = state + _STEP
        draw = mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
        live = time < latest[owner]
        if not live.all():
            owner, state, time, width, limit, draw = (x[live] for x in (owner, state, time, width, limit, draw))
        other = mix(draw ^ _OTHER)
        # The lower half chooses the register, the upper half the place in the range.
        place = ((other >> np.uint64(32)) * width.astype(np.uint64)) >> np.uint64(32)
        counts = place.astype(np.int64) < limit
        register = (other & np.uint64(0xFFFFFFFF)).astype(np.int64) % m
        np.minimum.at(registers, (owner * m + register)[counts], time[counts])
        seen = np.flatnonzero(np.bincount(owner, minlength=docs))
        latest[seen] = registers.reshape(docs, m)[seen].max(axis=1)
        live = time < latest[owner]
        owner, state, time, width, limit = (x[live] for x in (owner, state, time, width, limit))
        at = owner
    return registers.reshape(docs, m)


def _signature_ints(registers: np.ndarray) -> np.ndarray:
    """Registers as 32-bit codes of their times."""
    return (mix(registers.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _parts(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their shingles, about CHUNK of them (one text at least)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to] or b"") < 6 * CHUNK):
                size += len(texts[to] or b"")
                to += 1
            codes, bounds = shingle_bags(texts[at:to], shingle)
            yield batch.slice(at, to - at), codes, bounds
            at = to


def text_key(text: Column) -> Column:
    """128 bits that stand for the text; NULL reads as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def signatures(docs: DataFrame, shingle: int = SHINGLE, m: int = REGISTERS) -> DataFrame:
    """(doc_id, key, n_shingles, signature); the signature is NULL for a text without words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, codes, bounds in _parts(batches, shingle):
            sizes = np.diff(bounds)
            registers = _signature_ints(bag_signatures(*weighted(codes, bounds), len(sizes), m))
            flat = pa.array(registers.reshape(-1))
            lists = pa.FixedSizeListArray.from_arrays(flat, m).cast(pa.list_(pa.int32()))
            lists = pc.if_else(pa.array(sizes > 0), lists, pa.scalar(None, lists.type))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), lists], names=["doc_id", "key", "n_shingles", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("key"), "text").mapInArrow(
        run, f"doc_id {kind}, key binary, n_shingles long, signature array<int>")


def _elements(docs: DataFrame, shingle: int) -> DataFrame:
    """(key, bag): each text's shingle occurrences as packed ascending codes; the second occurrence of a shingle is another element."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, codes, bounds in _parts(batches, shingle):
            doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            first = group_starts(codes, doc)
            nth = np.arange(len(codes)) - np.repeat(first, sizes_of(first, len(codes)))
            elements = mix(codes + nth.astype(np.uint64) * _STEP)
            bags = [pack_sorted(np.sort(elements[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bags, pa.binary())], names=["key", "bag"])

    return docs.select(text_key(F.col("text")).alias("key"), "text").mapInArrow(run, "key binary, bag binary")


def _paired(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    left = bags.select(F.col("key").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("key").alias("b"), F.col("bag").alias("bag_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "bag_a", "bag_b")


def _bags(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column(2), batch.column(3), strict=True):
        yield unpack_sorted(x.as_py()), unpack_sorted(y.as_py())


def _sketch(elements: np.ndarray) -> list[int]:
    bits = np.zeros(64 * SKETCH_WORDS, np.uint8)
    bits[(elements >> np.uint64(40)) % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.int64).tolist()


def compare(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of both bags, their common elements, and sketches of what b lacks of a and has beyond it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in _bags(batch):
                common = np.intersect1d(x, y, assume_unique=True)
                rows.append((len(x), len(y), len(common), _sketch(np.setdiff1d(x, common, assume_unique=True)),
                             _sketch(np.setdiff1d(y, common, assume_unique=True))))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
                                             names=["a", "b", "size_a", "size_b", "common", "lacks", "beyond"])

    return _paired(pairs, bags).mapInArrow(run, "a binary, b binary, size_a long, size_b long, common long, lacks array<long>, beyond array<long>")


def _reaches(common: Column, sizes: Column, least: float) -> Column:
    """Whether an overlap gives a weighted Jaccard similarity of ``least``: common / (sizes - common)."""
    return common.cast("double") >= least * (sizes - common) - 1e-9


def _most_common(x: str, y: str) -> Column:
    """An upper bound on the common elements of two texts from their comparison with one pivot.

    A bit set in one sketch only is an element the other text surely does not share.
    """
    def only(name: str, s: str, t: str) -> Column:
        apart = F.zip_with(F.col(f"{s}.{name}"), F.col(f"{t}.{name}"), lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v))))
        return F.aggregate(apart, F.lit(0), lambda n, e: n + e).cast("long")

    def shared(name: str, size) -> Column:
        return F.least(size(x) - only(name, x, y), size(y) - only(name, y, x))

    def lacking(t: str) -> Column:
        return F.col(f"{t}.size_a") - F.col(f"{t}.common")

    def extra(t: str) -> Column:
        return F.col(f"{t}.size_b") - F.col(f"{t}.common")

    of_pivot = F.col(f"{x}.common") - lacking(y) + shared("lacks", lacking)
    return of_pivot + shared("beyond", extra)


def _loose_common(x: str, y: str) -> Column:
    """The same bound without the sketches: cheap enough to look at first."""
    return F.least(F.col(f"{x}.common"), F.col(f"{y}.common")) + F.least(
        F.col(f"{x}.size_b") - F.col(f"{x}.common"), F.col(f"{y}.size_b") - F.col(f"{y}.common"))


def _buckets(texts: DataFrame, m: int, rows: int) -> DataFrame:
    """(bucket, key): a row for each band of each text's signature."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(m // rows - 1)), lambda b: F.xxhash64(b, F.slice("signature", b * rows + 1, rows)))
    return texts.filter(F.col("signature").isNotNull()).select(F.explode(bands).alias("bucket"), "key")


def near_classes(docs: DataFrame, least: float = SIMILARITY, shingle: int = SHINGLE, m: int = REGISTERS,
                 rows: int = BAND_ROWS) -> DataFrame:
    """Per document: doc_id, key (of its text), class_id (the smallest doc_id of its class) and n_shingles.

    Classes are the connected components of texts whose shingle multisets overlap by
    ``least`` or more; equal texts are one text, NULL and empty texts too.  A text with
    fewer words than a shingle is one shingle; a text without words is like none but
    its equals.  Repeated rows fall into one class; a class whose ids are all NULL has
    a NULL class_id.  An empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs, shingle, m), "signatures")
    texts = signed.groupBy("key").agg(F.first("signature").alias("signature"))
    buckets = _buckets(texts, m, rows)
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Members of buckets with several texts, and how often each meets others in all its buckets.
    members = stored(buckets.join(shared, "bucket"), "bucket-members")
    central = members.groupBy("key").agg(F.sum("n").alias("meets"))
    pivots = members.join(central, "key").groupBy("bucket").agg(F.max(F.struct("meets", "key")).alias("top"))
    stars = members.join(pivots, "bucket").select(F.col("top.key").alias("a"), F.col("key").alias("b")).filter("a != b").distinct()
    # One document of each text in question; rows of the same id with other texts fall out with the join on the key.
    asked = members.select("key").distinct()
    owners = signed.join(asked, "key").groupBy("key").agg(F.min("doc_id").alias("owner"))
    wanted = owners.select("owner").distinct()
    bags = _elements(docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("owner")), "left_semi"), shingle)
    bags = stored(bags.join(asked, "key", "left_semi").dropDuplicates(["key"]), "bags")
    stars = stored(compare(stars, bags), "stars")
    links = stars.filter(_reaches(F.col("common"), F.col("size_a") + F.col("size_b"), least)).select("a", "b")
    labels = components(links)
    # Pairs of one pivot that are still apart: one of the two is not in the pivot's class.
    label = labels.select(F.col("node"), F.col("label"))
    placed = stars.join(label.toDF("a", "label_a"), "a", "left").join(label.toDF("b", "label"), "b", "left")
    placed = stored(placed.withColumns({"label": F.coalesce("label", "b"), "label_a": F.coalesce("label_a", "a")}), "placed")
    x, y = placed.filter("label != label_a").alias("x"), placed.alias("y")
    sizes = F.col("x.size_b") + F.col("y.size_b")
    apart = (F.col("x.label") < F.col("y.label")) | ((F.col("x.label") > F.col("y.label")) & (F.col("y.label") == F.col("y.label_a")))
    more = x.join(y, (F.col("x.a") == F.col("y.a")) & apart & _reaches(_loose_common("x", "y"), sizes, least)
                  & _reaches(_most_common("x", "y"), sizes, least))
    more = more.select(F.col("x.b").alias("a"), F.col("y.b").alias("b")).distinct()
    more = stored(compare(more, bags).filter(_reaches(F.col("common"), F.col("size_a") + F.col("size_b"), least)).select("a", "b"), "more-links")
    labels = components(links.unionByName(more)).withColumnRenamed("node", "key")
    named = signed.select("doc_id", "key", "n_shingles").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = stored(named, "named")
    ids = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return named.join(ids, "label").select("doc_id", "key", "class_id", "n_shingles")


def class_report(docs: DataFrame) -> DataFrame:
    """The digest of the query: every document with its class; the first of a class is the one to keep."""
    return near_classes(docs).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("is_first"), "n_shingles")


@apart("doc_id", "text")
def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id; of equal rows of that id one stays."""
    found = near_classes(docs).select(F.col("key").alias("key_"), F.col("doc_id").alias("doc_"), F.col("class_id").alias("class_"))
    first = found.filter(F.col("doc_").eqNullSafe(F.col("class_"))).groupBy("class_", "doc_").agg(F.min("key_").alias("key_"))
    first = stored(first.select("doc_", "key_"), "first")
    keyed = docs.withColumn("text_key_", text_key(F.col("text")))
    kept = keyed.join(first, keyed["doc_id"].eqNullSafe(first["doc_"]) & (keyed["text_key_"] == first["key_"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_key_"]).select(*docs.columns)
