"""Callers' columns of the operators' own names are handed on unchanged by every stage that hands on columns."""

import pytest
from pyspark.sql import functions as F

from rillmart.llm import bagminhash, line_rules, line_runs, mixing, periodic_runs, substring_dedup

#: Names used inside, with a closing underscore and without.
INNER = ["key_", "block_", "text_key_", "doc_", "class_", "copy_", "mix_", "source_key_", "plan_", "source_of_", "doc_key_", "base_", "often_", "clean_", "rules_", "host_",
         "near_", "row_", "answers", "carried_0_", "carried_5_", "gone", "h1", "h2", "first", "id", "pos"]


@pytest.mark.parametrize("stage", [
    line_rules.keep_good, bagminhash.keep_first, substring_dedup.cut_repeats, mixing.mix, line_runs.drop_repeated_lines, periodic_runs.collapse_runs])
def test_stage_hands_on_columns(edges, stage):
    named = edges.withColumns({c: F.lit(f"own {c}") for c in INNER}).withColumn("odd name.x", F.lit(1))
    out, plain = stage(named), stage(edges)
    assert out.columns == named.columns
    rows = out.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in INNER) and all(r["odd name.x"] == 1 for r in rows)

    def texts(found):
        return sorted((str(r.doc_id), str(r.text), str(r.n_chars), str(r.source)) for r in found)

    assert texts(rows) == texts(plain.collect())
