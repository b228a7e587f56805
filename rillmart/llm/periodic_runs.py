"""Periodic runs of words by descending LCP.

A run of period q starts at s where the suffixes at s and s + q have a common prefix
of the run's length less q, and no suffix between them has one as long.  So suffixes
are put in order, and classes of them are united by decreasing LCP, as Kruskal's
algorithm does.  A class is an ordered set of word positions: two positions that
become neighbours in one, no further apart than the LCP, are the start of a run and
its second period.

Texts are independent and stay in the task that reads them.  Suffix ranks are found by
doubling in numpy for many texts at once; only the union-find is a plain loop, over
the few positions that can begin a run.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, let, words_of
from .grams import gram_codes, group_starts, inside, sizes_of

#: A run has at least so many words and so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Its first two suffixes have at least this LCP: six words less a period of one, or three periods of two.
LEAST_LCP = 5
#: Bytes of text handled at once, by whole texts.
CHUNK_BYTES = 4_000_000


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def number_words(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, equal words' numbers in a row, and the bounds of each text; bytes.split() parts at [\\x20\\x09-\\x0D]."""
    numbers = _Numbers()
    words = [text.split() if text else [] for text in texts]
    parts = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return words, (np.concatenate(parts) if parts else np.zeros(0, np.int64)), bounds


def _promising(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The texts that can hold a run.

    In one, every position but the last few has its five words again within a period,
    in a stretch of three periods less four positions at least.
    """
    n = len(codes)
    hashes = gram_codes(codes.astype(np.uint64), LEAST_LCP) + doc[:max(0, n - LEAST_LCP + 1)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero(inside(doc, LEAST_LCP))
    hashes = hashes[at]
    ordered = np.sort(hashes)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(repeated):
        return np.zeros(0, np.int64)
    slot = np.minimum(np.searchsorted(repeated, hashes), len(repeated) - 1)
    hit = repeated[slot] == hashes
    at, slot = at[hit], slot[hit]
    order = np.argsort(slot, kind="stable")
    gap = np.zeros(n + 1, np.int64)
    same = slot[order[1:]] == slot[order[:-1]]
    gap[at[order[:-1]][same]] = (at[order[1:]] - at[order[:-1]])[same]
    # How many positions in a row, from each on, have their words again.
    ends = np.flatnonzero(gap == 0)
    here = np.flatnonzero(gap)
    stretch = ends[np.searchsorted(ends, here)] - here
    return np.unique(doc[here[stretch + LEAST_LCP - 1 >= (LEAST_PERIODS - 1) * gap[here]]])


def _dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of numbers from -1 on, equal for equal pairs."""
    key = first * (int(second.max(initial=0)) + 2) + (second + 1)
    return np.unique(key, return_inverse=True)[1].reshape(-1)


def suffix_ranks(codes: np.ndarray, doc: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(length, rank of the words from each position on), lengths doubling until all ranks differ; texts come one after another.

    Ranks have a -1 more at their end.  A suffix shorter than the length is followed by nothing, which comes first.
    """
    n = len(codes)
    rank = _dense(doc, codes)
    levels, length = [], 1
    while True:
        levels.append((length, np.append(rank, -1).astype(np.int32)))
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            return levels
        after = np.full(len(tied), -1, np.int64)
        to = tied + length
        ok = to < n
        ok[ok] = doc[to[ok]] == doc[tied[ok]]
        after[ok] = rank[to[ok]]
        # Ranks count the suffixes before: a tied class is ordered within the room it has.
        if length == 1:
            rank = (np.cumsum(np.bincount(rank)) - np.bincount(rank))[rank]
            after[ok] = rank[to[ok]]
        old = rank[tied]
        order = np.lexsort((after, old))
        first = group_starts(old[order], after[order])
        group = np.repeat(np.arange(len(first)), sizes_of(first, len(order)))
        base = group_starts(old[order])
        offset = first - np.repeat(base, sizes_of(base, len(order)))[first]
        rank = rank.copy()
        rank[tied[order]] = old[order] + offset[group]
        length *= 2


def _common(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, different positions of one text."""
    total = np.zeros(len(a), np.int64)
    top = len(levels[0][1]) - 1
    for length, rank in reversed(levels):
        same = rank[np.minimum(a + total, top)] == rank[np.minimum(b + total, top)]
        total += length * same
    return total


def _candidates(codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in suffix order that may be a run's first two, the LCP of each with the next (0: another class), and for
    every word the one before it in its text (-1: none)."""
    levels = suffix_ranks(codes, doc)
    order = np.argsort(levels[-1][1][:-1])
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        near = np.flatnonzero(doc[order[1:]] == doc[order[:-1]])
        lcp[near] = _common(levels, order[near], order[near + 1])
    before = np.full(len(codes), -1, np.int64)
    before[1:] = np.where(doc[1:] == doc[:-1], codes[:-1], -1)
    while True:
        lcp[lcp < LEAST_LCP] = 0
        start = np.flatnonzero(np.r_[True, lcp[:-1] == 0])
        size = sizes_of(start, len(order))
        number = np.repeat(np.arange(len(start)), size)
        # All of a class after the same word: its positions only go on runs that begin before.
        mixed = np.minimum.reduceat(before[order], start) != np.maximum.reduceat(before[order], start)
        # Nothing near enough for the longest prefix shared with any other suffix.
        by_place = np.lexsort((order, number))
        place = order[by_place]
        step = np.where(number[1:] == number[:-1], np.diff(place), np.iinfo(np.int64).max // 8)
        room = np.iinfo(np.int64).max // 8
        gap = np.empty(len(order), np.int64)
        gap[by_place] = np.minimum(np.r_[step, room], np.r_[room, step])
        most = np.maximum(lcp, np.r_[0, lcp[:-1]])
        keep = mixed[number] & ((LEAST_PERIODS - 1) * gap <= most)
        if keep.all() or not keep.any():
            return order[keep], lcp[keep], before
        # Between two that stay the least LCP on the way counts.
        at = np.flatnonzero(keep)
        lcp = np.minimum.reduceat(lcp, at)
        order = order[at]
        lcp[-1] = 0


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, ordered by text, start and period."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    chosen = _promising(codes, doc)
    none = np.zeros(0, np.int64)
    if not len(chosen):
        return none, none, none, none
    words = np.isin(doc, chosen)
    place = np.flatnonzero(words)
    order, lcp, before = _candidates(codes[words], doc[words])
    found = kruskal(order, lcp, before)
    start, length, period = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (none, none, none)
    text = doc[words][start]
    start = place[start] - bounds[text]
    by = np.lexsort((period, start, text))
    return text[by], start[by], length[by], period[by]


def kruskal(order: np.ndarray, lcp: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs among positions in suffix order, by uniting neighbours in this order from the longest LCP on."""
    edges = np.flatnonzero(lcp > 0)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    members: dict[int, list[int]] = {}
    home: dict[int, int] = {}

    def find(x: int) -> int:
        root = home.setdefault(x, x)
        while root != home[root]:
            root = home[root]
        while home[x] != root:
            home[x], x = root, home[x]
        return root

    out, pending, level = [], [], -1

    def close() -> None:
        # Only what is still next to each other after all unions of the level.
        for a, b in pending:
            positions = members[find(a)]
            if positions[bisect_left(positions, a) + 1] == b:
                out.append((a, b - a + level, b - a))
        pending.clear()

    for u, v, common in zip(order[edges].tolist(), order[edges + 1].tolist(), lcp[edges].tolist(), strict=True):
        if common != level:
            close()
            level = common
        big, small = find(u), find(v)
        one, two = members.pop(big, None) or [big], members.pop(small, None) or [small]
        if len(one) < len(two):
            big, small, one, two = small, big, two, one
        furthest = common // (LEAST_PERIODS - 1)
        for x in two:
            insort(one, x)
        own = set(two)
        for x in two:
            k = bisect_left(one, x)
            for a, b in ((one[k - 1] if k else x, x), (x, one[k + 1] if k + 1 < len(one) else x)):
                met = a not in own or b not in own
                if met and b - a <= furthest and b - a + common >= LEAST_WORDS and (before[a] < 0 or before[a] != before[b]):
                    pending.append((a, b))
        home[small] = big
        members[big] = one
    close()
    return sorted(out)


def dropped_words(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """For each of ``n`` words whether a run holds it after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge)[:n] > 0


def _chunks(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        texts = batch.column(column).cast(pa.binary()).to_pylist()
        at = size = 0
        for k, text in enumerate(texts):
            size += len(text or b"")
            if size >= CHUNK_BYTES or k + 1 == len(texts):
                yield batch.slice(at, k + 1 - at), texts[at:k + 1]
                at, size = k + 1, 0


def _each(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Per text its words and its runs' starts, lengths and periods."""
    words, codes, bounds = number_words(texts)
    text, start, length, period = find_runs(codes, bounds)
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    for k, w in enumerate(words):
        own = slice(cut[k], cut[k + 1])
        yield w, start[own], length[own], period[own]


def _collapsed(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    if not len(runs[0]):
        return b" ".join(words)
    gone = dropped_words(len(words), *runs)
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period): a row per run of each text, words numbered from 0.

    A run is a stretch with smallest period ``period`` of at least six words and four
    periods that no neighbour extends.  NULL and empty texts have none; each row is a
    text of its own, so repeated rows repeat their runs; an empty table gives an empty
    one.  Texts are taken whole; memory is some 4 bytes a word and doubling of the
    longest repeat, for one long text or a few megabytes of short ones.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches, 1):
            runs = [r for _, *r in _each(texts)]
            rows = np.repeat(np.arange(len(texts)), [len(r[0]) for r in runs])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows)), *[pa.array(np.concatenate([r[k] for r in runs]) if runs else [], pa.int64()) for k in range(3)]],
                names=["doc_id", "start", "length", "period"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, period long")


@apart("text", "n_chars")
def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with only the first period of every run left; all other columns stay, n_chars follows the text.

    Texts without a run, NULL and empty ones included, stay as they are; in the others
    words are joined by one space.
    """
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches, text_at):
            left = [_collapsed(w, r).decode() if len(r[0]) else None for w, *r in _each(texts)]
            columns = part.columns
            columns[text_at] = pa.array([old if new is None else new for old, new in zip(columns[text_at].to_pylist(), left, strict=True)], columns[text_at].type)
            if chars_at is not None:
                columns[chars_at] = pa.array([old if new is None else len(new) for old, new in zip(columns[chars_at].to_pylist(), left, strict=True)],
                                             columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in texts whose h = crc32(doc_id) is a multiple of 10, the words from a on repeat with a period p.

    With g = h div 10 and n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    Texts without words, and rows without a doc_id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def rewritten(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)

        def of(place: Column) -> Column:
            def word(i: Column) -> Column:
                return F.get(words, F.when(i < place["a"], i).otherwise(place["a"] + (i - place["a"]) % place["p"]).cast("int"))

            return F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), word))

        place = F.struct(a.alias("a"), (F.lit(1) + F.floor((n - a) / (g % 8 + 3))).alias("p"))
        return F.when(n > 0, let(place, of)).otherwise(F.col("text"))

    return docs.select("doc_id", F.when(h % 10 == 0, let(words_of(F.col("text")), rewritten)).otherwise(F.col("text")).alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """The digest of the query: per document its runs' number, the longest one, and digests of all runs and of the collapsed text.

    Of equally long runs the first by start and then by period is the longest;
    without any its four columns are NULL.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _chunks(batches, 1):
            rows = []
            for words, *runs in _each(texts):
                listed = list(zip(*[x.tolist() for x in runs], strict=True))
                best = min(listed, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                lines = "".join([f"{s},{n},{p}\n" for s, n, p in listed])
                rows.append((len(listed), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
                             hashlib.sha256(_collapsed(words, runs)).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[
                "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_runs long, start long, length long, period long, exponent_milli long, "
             "runs_sha256 string, collapsed_sha256 string")
