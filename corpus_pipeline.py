"""A corpus from raw documents to token digests, as stages that each write their documents for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillmart.llm import bagminhash, line_rules, mixing, queries, sentencepiece_bpe, substring_dedup
from rillmart.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines too many documents of their host share."""
    return line_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return bagminhash.keep_first(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the word runs that an earlier document holds."""
    return substring_dedup.cut_repeats(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document: the number of its token ids, digests of the ids and of the decoded text."""
    return sentencepiece_bpe.token_digests(docs, queries.piece_model())


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substrings),
    ("mixing sources", mixing_sources),
    ("sentencepiece", tokens),
]

#: Sketches, drawn copies and a tokenizer are beyond SQL; each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
