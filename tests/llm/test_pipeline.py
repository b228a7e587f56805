"""The registered queries and the stages of the corpus pipeline."""

import re

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from rillmart.llm import queries as llm_queries
from rillmart.llm.common import stored

from .conftest import SF_DIR
from .test_bagminhash import classes
from .test_line_rules import verdicts
from .test_substring_dedup import brute as removed


def test_all_operators_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in llm_queries.QUERIES} == set(range(1, 14))
    assert {*llm_queries.QUERIES, "pipeline"} <= set(queries())
    assert set(llm_queries.ORACLES) <= set(oracle_sql())


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "substring dedup", "mixing sources", "sentencepiece"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = stored(stage(spark, docs, SF_DIR), "test-stage")
        after = [r.asDict() for r in docs.collect()]
        if name != "sentencepiece":
            assert docs.columns == columns and all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "quality rules":
            v = verdicts([(r["text"], r["source"]) for r in before], 20, 0.1, 0.5)
            assert {(r["doc_id"], r["text"]) for r in after} == {(r["doc_id"], left) for r, (kept, left) in zip(before, v, strict=True) if kept}
        elif name == "near dedup":
            best = {}
            for r, c in zip(before, classes([r["text"] for r in before]), strict=True):
                best[c] = min(best.get(c, r["doc_id"]), r["doc_id"])
            assert sorted(r["doc_id"] for r in after) == sorted(best.values())
        elif name == "substring dedup":
            want = {x[0]: x for x in removed([(r["doc_id"], r["text"]) for r in before], 13)}
            assert len(after) == len(before)
            assert all(r["text"].split() == want[r["doc_id"]][4].split() for r in after)
        elif name == "mixing sources":
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
        else:
            assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)


def test_run_is_the_chain_of_stages(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0
