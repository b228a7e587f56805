"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    backoff_lm,
    bagminhash,
    html_diff,
    licences,
    line_rules,
    line_runs,
    mixing,
    multi_index,
    periodic_runs,
    quality_model,
    sentencepiece_bpe,
    substring_dedup,
    token_alignment,
)
from .common import read
from .oracle import ORACLES as ORACLES


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.backoff_scores(read(spark, sf_dir, "documents"))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_report(read(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_report(read(spark, sf_dir, "documents"))


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.class_report(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rules_report(read(spark, sf_dir, "documents"))


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.main_texts(read(spark, sf_dir, "pages"))


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer lies; its place is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model() -> str:
    return tokenizer_file("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.token_digests(read(spark, sf_dir, "documents"), piece_model())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_report(periodic_runs.with_planted_periods(read(spark, sf_dir, "documents")))


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_report(read(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), piece_model())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_lm_scores": op2_lm_scores,
    "op3_licence_scan": op3_licence_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_bagminhash": op5_bagminhash,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_text": op7_html_text,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_multi_index": op9_multi_index,
    "op10_mix_sources": op10_mix_sources,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_line_runs": op12_line_runs,
    "op13_token_alignment": op13_token_alignment,
}
