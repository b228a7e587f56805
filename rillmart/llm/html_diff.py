"""Main text of web pages by differencing each page with the page of the nearest URL on its host.

Pages of a host are ordered by URL path; a page is paired with the nearest page of other
text whose path shares more leading segments.  Their text lines are aligned by longest
common subsequence: lines both pages share belong to the template and are deleted.  What
the markup itself calls furniture goes as well.  Inside an article, and beside a page that
is nearly a copy, a shared line goes only if it is common on the host.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import buckets_for, stored
from .html_blocks import Block, blocks

#: Of a neighbour that shares more than this part of the open lines, only lines common on the host are taken for template.
COPY_SHARE = 0.8
#: A line is common on a host when this share of its distinct texts, and so many of them, hold it.
COMMON_SHARE = 0.5
COMMON_TEXTS = 3
#: Pairs of equal lines up to which the alignment lists them all.
LISTED_PAIRS = 200_000


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """LCS lengths of all of ``a`` with each prefix of ``b``, by one machine-word-parallel step per line of ``a``."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out, n = [0], 0
    for bit in reversed(f"{v:0{len(b)}b}" if b else ""):
        n += bit == "0"
        out.append(n)
    return out


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of one longest common subsequence of ``a`` and ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    return [*range(head), *(head + i for i in _middle(x, y)), *range(len(a) - tail, len(a))]


def _middle(a: list[int], b: list[int]) -> list[int]:
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    if not where or not a:
        return []
    if sum(len(where.get(x, ())) for x in a) <= LISTED_PAIRS or len(a) == 1:
        # Longest ascending run of places in b; a line's own places come in descending order, so it takes one at most.
        ends: list[int] = []
        chains: list[tuple | None] = []
        for i, x in enumerate(a):
            for j in where.get(x, ()):
                k = bisect_left(ends, j)
                link = (i, chains[k - 1] if k else None)
                if k == len(ends):
                    ends.append(j)
                    chains.append(link)
                else:
                    ends[k], chains[k] = j, link
        out, link = [], chains[-1] if chains else None
        while link:
            out.append(link[0])
            link = link[1]
        return out[::-1]
    # Many repeated lines: halve a, and cut b where both halves together keep the most.
    mid = len(a) // 2
    left, right = _lengths(a[:mid], b), _lengths(a[:mid - 1:-1] if mid else a[::-1], b[::-1])
    cut = max(range(len(b) + 1), key=lambda j: left[j] + right[len(b) - j])
    return [*_middle(a[:mid], b[:cut]), *(mid + i for i in _middle(a[mid:], b[cut:]))]


def main_level(page: list[Block]) -> int:
    """Level from which on blocks are main text: articles, unless a main part holds more text beside them; 0 without either."""
    sizes = [0, 0, 0]
    for b in page:
        sizes[b.level] += 0 if b.chrome else len(b.text)
    return 2 if sizes[2] and sizes[2] >= sizes[1] else 1 if sizes[1] else 0


def main_lines(page: list[Block], neighbour: list[int] | None) -> list[str]:
    """The lines of the main text: the page's lines without shared ones, furniture, and what lies beside its article.

    Codes of the neighbour's lines that are common on the host come inverted (~).
    """
    best = main_level(page)
    codes = line_codes(page)
    common = {~x for x in neighbour or () if x < 0}
    shared = set(shared_lines(codes, [x if x >= 0 else ~x for x in neighbour])) if neighbour else set()
    open_ = [i for i, b in enumerate(page) if not b.chrome and b.level >= best]
    if best or len(shared.intersection(open_)) > COPY_SHARE * len(open_):
        # Lines of an article, or of nearly a copy of the neighbour, are text where the neighbour has them too but few others do.
        shared.difference_update(i for i in open_ if codes[i] not in common)
    return [page[i].text for i in open_ if i not in shared]


def line_codes(page: list[Block]) -> list[int]:
    return [xxh3_64_intdigest(b.text) >> 1 for b in page]


def _page_text(value) -> str:
    return (value.as_py() or b"").decode("utf-8", "replace")


def _row_key() -> Column:
    return F.xxhash64("page_id", "url", "html")


def _segments(path: Column) -> Column:
    return F.split(path, "/")


def _nearness(here: Column, there: Column) -> Column:
    """Leading path segments two URLs of one host share; -1 for another host."""
    a, b = _segments(here["path"]), _segments(there["path"])
    n = F.least(F.size(a), F.size(b))
    differ = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    return F.when(there["host"] == here["host"], F.when(differ > 0, differ - 1).otherwise(n)).otherwise(-1)


def page_lines(pages: DataFrame) -> DataFrame:
    """(row, host, path, sig, lines, mains): per page the codes of its lines, of its main lines, and a hash of the latter."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)

    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, sigs, mains = [], [], []
            for x in batch.column(3).cast(pa.binary()):
                page = blocks(_page_text(x))
                best, codes = main_level(page), line_codes(page)
                open_ = [c for b, c in zip(page, codes, strict=True) if not b.chrome and b.level >= best]
                lines.append(codes)
                sigs.append(xxh3_64_intdigest(array("q", open_).tobytes()) >> 1)
                mains.append(list(dict.fromkeys(open_)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sigs, pa.int64()), pa.array(lines, pa.list_(pa.int64())), pa.array(mains, pa.list_(pa.int64()))],
                names=["row", "host", "path", "sig", "lines", "mains"])

    rows = pages.select(_row_key().alias("row"), host.alias("host"), path.alias("path"), "html")
    return stored(rows.mapInArrow(parsed, "row long, host string, path string, sig long, lines array<long>, mains array<long>"), "page-lines")


def common_lines(parsed: DataFrame) -> DataFrame:
    """(h, often): per hash of a host the main lines that are common on it; no more than 1 / COMMON_SHARE times the mean number of lines."""
    texts = parsed.groupBy(F.xxhash64("host").alias("h"), "sig").agg(F.first("mains").alias("mains"))
    marked = texts.select("h", F.explode(F.concat("mains", F.array(F.lit(-1).cast("long")))).alias("line"))
    counts = marked.groupBy("h", "line").agg(F.count(F.lit(1)).alias("n"))
    # The line -1 stands for the text itself, so its count is the host's number of distinct texts.
    counts = stored(counts.filter(F.col("n") >= COMMON_TEXTS), "page-line-counts")
    hosts = counts.filter("line = -1").select("h", F.col("n").alias("texts"))
    often = counts.filter("line >= 0").join(hosts, "h").filter(F.col("n") >= F.col("texts") * COMMON_SHARE)
    # Written, so that the join below sees its size, and can split a large host where it is not sent to all.
    return stored(often.groupBy("h").agg(F.sort_array(F.collect_list("line")).alias("often")), "common-lines")


def _beside(keys: DataFrame, *part: str) -> DataFrame:
    """Columns b and a: of each key the last before and the first after it that has another host or another text, in its part."""
    k = F.col("k")

    def beside(order: Column, name: str, df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(order) if part else Window.orderBy(order)
        df = df.withColumn("last_", F.lag("k").over(w))
        other = (F.col("last_")["host"] != k["host"]) | (F.col("last_")["sig"] != k["sig"])
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.last(F.when(other, F.col("last_")), ignorenulls=True).over(run)).drop("last_")

    return beside(k.desc(), "a", beside(k.asc(), "b", keys))


def nearest_pages(pages: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """(row, near): for each page the neighbour in URL order on its host that shares the longer path; NULL without one.

    Copies are passed over: the neighbour is the next page with other main lines.  Only
    keys are sorted.  Range partitions keep a large host in many tasks; each partition's
    outermost two runs of copies are handed to the others.
    """
    parsed = page_lines(pages) if parsed is None else parsed
    keys = parsed.select(F.struct("host", "path", "row", "sig").alias("k")).distinct()
    parts = buckets_for(pages.sparkSession)
    placed = stored(keys.repartitionByRange(parts, "k").withColumn("part", F.spark_partition_id()), "urls")
    inner = _beside(placed, "part")
    # At most four rows per partition: its ends, and the ends of the runs next to those.
    ends = inner.groupBy("part").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.max("b").alias("b"), F.min("a").alias("a"))
    ends = stored(ends, "url-ends")
    edges = _beside(ends.select(F.explode(F.array("first", "last", "b", "a")).alias("k")).filter(F.col("k").isNotNull()).distinct())
    edge_before = ends.join(edges, ends["first"] == edges["k"]).select("part", edges["b"].alias("edge_before"))
    edge_after = ends.join(edges, ends["last"] == edges["k"]).select("part", edges["a"].alias("edge_after"))
    k = F.col("k")
    both = inner.join(edge_before, "part").join(edge_after, "part").select(k, F.coalesce("b", "edge_before").alias("b"), F.coalesce("a", "edge_after").alias("a"))
    before, after = F.coalesce(_nearness(k, F.col("b")), F.lit(-1)), F.coalesce(_nearness(k, F.col("a")), F.lit(-1))
    near = F.when((before < 0) & (after < 0), F.lit(None)).when(before >= after, F.col("b.row")).otherwise(F.col("a.row"))
    return both.select(F.col("k.row").alias("row"), near.alias("near"))


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars (code points).

    NULL and empty pages have an empty text; a NULL url has no host and pairs with its
    like.  Repeated rows are one page to their neighbours and give equal rows.  A page
    without a neighbour is judged by its markup alone.  An empty table gives an empty one.
    """
    pages = pages.select("page_id", "url", "html")
    parsed = page_lines(pages)
    marked = F.when(F.col("often").isNull(), F.col("lines")).otherwise(
        F.transform("lines", lambda x: F.when(F.array_contains("often", x), F.bitwise_not(x)).otherwise(x)))
    near = nearest_pages(pages, parsed)
    # A page stands beside two runs of copies at most; of a run only its ends are asked for, but by all copies of the next.
    asked = parsed.withColumn("h", F.xxhash64("host")).join(common_lines(parsed), "h", "left")
    asked = asked.select(F.col("row").alias("near"), marked.alias("lines")).dropDuplicates(["near"])
    beside = near.join(asked, "near").select(F.col("row").alias("row_"), "lines")

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_lines(blocks(_page_text(h)), n.as_py()) for h, n in zip(batch.column(2).cast(pa.binary()), batch.column(3), strict=True)]
            joined = ["\n".join(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(joined, pa.string()), pa.array([len(x) for x in joined], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.withColumn("row_", _row_key()).join(beside, "row_", "left").select("page_id", "url", "html", "lines")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return rows.mapInArrow(texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
