"""Text expressions: keyword splitting, joining, padding, naming."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timefns import col

# Fixed value: single Han characters, or runs of letters of one of the scripts written without spaces, or of any other
# letters and digits, with their marks.
WORD_PATTERN = r"(\p{IsHan}|[\p{IsHiragana}ー]+|[\p{IsKatakana}ー]+|\p{IsThai}+|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]+)"
HAN_PAIR_PATTERN = r"(?=(\p{IsHan}{2}))"


def words(text: Column | str, han_pairs: bool = False) -> Column:
    """Lower-cased words of a text in order, repeats kept, as ``array<string>``.

    ``han_pairs`` adds every two neighbouring Han characters as a word.
    """
    lowered = F.lower(col(text))
    found = F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(1))
    if not han_pairs:
        return found
    return F.concat(found, F.regexp_extract_all(lowered, F.lit(HAN_PAIR_PATTERN), F.lit(1)))


def words_by(text: Column | str, tokenizer: Callable[[str], list[str]]) -> Column:
    """Words by a tokenizer of one's own, run over Arrow batches; where it fails the whole text is one word."""
    def split(texts: pd.Series) -> pd.Series:
        def one(value):
            if value is None:
                return None
            try:
                return list(tokenizer(value))
            except Exception:  # noqa: BLE001 - any tokenizer error leaves the text whole
                return [value]

        return texts.map(one)

    return F.pandas_udf(split, "array<string>")(col(text))


def explode_words(df: DataFrame, text: str, out: str = "word", han_pairs: bool = False,
                  stop_words: DataFrame | None = None,
                  tokenizer: Callable[[str], list[str]] | None = None) -> DataFrame:
    """One row per word; texts without a word give no row.

    ``stop_words`` is a one-column table ``word`` of words to leave out.
    """
    found = words_by(text, tokenizer) if tokenizer else words(text, han_pairs)
    split = df.withColumn(out, F.explode(found)).drop(text)
    if stop_words is None:
        return split
    return split.join(stop_words.select(F.col("word").alias(out)), out, "left_anti")


def pad2(number: Column | str) -> Column:
    return F.lpad(col(number).cast("string"), 2, "0")


def snake_to_camel(name: str) -> str:
    """``ORDER_ID`` / ``order_id`` -> ``orderId``."""
    return re.sub(r"_+([a-z0-9])", lambda m: m.group(1).upper(), name.lower())


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_to_camel(c) for c in df.columns])
