"""Line dedup against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from rillmart.llm import line_runs

from .conftest import prose

WHITE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(WHITE).translate(FOLD)


def left_lines(rows):
    """Of (doc_id, text) rows: the lines that are left, by row."""
    last = 2 ** 63 - 1
    first = {}
    for i, t in rows:
        i = last if i is None else i
        for x in (t or "").split("\n"):
            first[key(x)] = min(i, first.get(key(x), last))
    return [[x for x in (t or "").split("\n") if len(key(x)) < 10 or first[key(x)] == (last if i is None else i)] for i, t in rows]


def dropped(rows):
    return [(t or "").count("\n") + 1 - len(left) for (_, t), left in zip(rows, left_lines(rows), strict=True)]


def digests(rows):
    return sorted((str(i), (t or "").count("\n") + 1, gone, hashlib.sha256("\n".join(left).encode()).hexdigest())
                  for (i, t), gone, left in zip(rows, dropped(rows), left_lines(rows), strict=True))


def reported(docs, report=line_runs.line_report):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in report(docs).collect())


@pytest.fixture(scope="module")
def line_rows(edge_rows):
    share = "Subscribe to our Newsletter"
    return [(i, t) for i, t, _ in edge_rows] + [
        (20, f"{share}\nown one line\n {share.upper()}\t\n\n"), (21, f"\x0b{share}\r\nshort\nown two line"), (22, f"{share}"), (22, f"{share}\nshort"),
        (23, "Éa é Éa é Éa\nshort"), (24, "éa é éa é éa\nÉA é Éa é Éa"), (25, "Kelvin scale of it"), (26, "kelvin scale of it"),
        (None, f"{share}\nonly without an id"), (None, "only without an id"), (-5, "only below zero line\n" + share), (27, "only below zero line\n\n"),
        (28, "\n".join(prose(k % 7, 5) for k in range(300))), (29, "\n".join(prose(k % 11, 5) for k in range(300)) + "\n"), (30, "123456789"), (31, "123456789"),
        (32, "1234567890"), (33, "1234567890"), (33, "1234567890\n1234567890")]


@pytest.fixture(scope="module")
def line_docs(docs_of, line_rows):
    return docs_of([(i, t, "s") for i, t in line_rows])


def test_digests(line_docs, line_rows):
    assert reported(line_docs) == digests(line_rows)


def test_every_number_of_batches_and_levels(line_docs, line_rows):
    # Equal rows share an entry, so each (id, text) counts once.
    want = sorted({(i, t): d for (i, t), d in zip(line_rows, dropped(line_rows), strict=True) if d}.values())
    for batches, fanout in ((1, 2), (3, 5), (7, 2)):
        assert sorted(len(r.gone) for r in line_runs.dropped_lines(line_docs, batches, fanout).collect()) == want


def test_texts_and_other_columns(line_docs, line_rows):
    out = line_runs.drop_repeated_lines(line_docs.withColumns({c: F.lit(f"own {c}") for c in ("id", "row", "gone", "doc", "pos", "h1", "batch", "line")}))
    assert out.columns[:len(line_docs.columns)] == line_docs.columns
    got = out.collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == sorted((str(i), "\n".join(x)) for (i, _), x in zip(line_rows, left_lines(line_rows), strict=True))
    assert all(r.id == "own id" and r.gone == "own gone" and r.doc == "own doc" and r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_runs_are_sorted_and_compacted(spark):
    runs = line_runs.LineRuns(spark, fanout=2, buckets=3)
    seen = set()
    for k in range(7):
        batch = spark.range(k * 50, k * 50 + 100).select(F.col("id") % 40 + k * 30, F.col("id") % 40 + k * 30, F.col("id")).toDF("h1", "h2", "id")
        keys = {r.h1 for r in batch.collect()}
        assert {r.h1 for r in runs.add(batch).collect()} == keys - seen
        seen |= keys
    # Seven batches in base two: one run on each of three levels.
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert sum(spark.table(n).count() for n in runs.names()) == len(seen)
    plan = runs.unseen(spark.range(10).selectExpr("id h1", "id * 2 h2"))._jdf.queryExecution().executedPlan().toString()
    # Only the batch is shuffled: the runs bring their buckets.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("SortMergeJoin") == 3


def test_whole_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert reported(documents) == digests(rows)


def test_no_rows(no_rows):
    assert line_runs.line_report(no_rows).collect() == []
    assert line_runs.drop_repeated_lines(no_rows).columns == no_rows.columns
