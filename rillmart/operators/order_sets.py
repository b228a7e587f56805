"""Sets of order ids that merge, for distinct counts over more than one window or group.

A count of distinct orders cannot be added up: an order with three products of one
brand is one order of the brand.  So each (window, group, kind of order) keeps the
ids themselves, cut into ranges of 32,768 (``bucket``).  A bucket of few ids is a short
array of places, one of many a bitmap of four kilobytes; either is bounded, whatever
a group holds, and a group of many orders is as many rows as its ids have buckets.
Sets of stored days are united over days, groups or both, and counted exactly.

Sets are built and united as words of 64 places, plain numbers that a hash aggregate
combines, so a group of one order costs one small row and a bitmap is made only
where one is kept or asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import stamp
from .stats import ORDER_KINDS

#: Up to so many ids of a bucket are kept as an array; a bitmap always takes 4,096 bytes.
MOST_LISTED = 1024
#: Words of 64 places in a bitmap of 32,768.
WORDS = 512


def _shift(place: Column) -> Column:
    """Where a place stands in its word: words are written high byte first, as ``hex`` shows them, and bytes hold their lowest place lowest."""
    return (F.lit(56) - place.bitwiseAND(F.lit(56)) + place.bitwiseAND(F.lit(7))).cast("int")


def _word(place: Column) -> Column:
    """The word of a place with its bit set: (word, value)."""
    place = place.cast("bigint")
    return F.struct(F.floor(place / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), _shift(place)).alias("value"))


def _words(bits: Column) -> Column:
    """The words of a bitmap that are not empty."""
    def read(word: Column) -> Column:
        return F.struct(word.alias("word"), F.conv(F.hex(F.substring(bits, word * 8 + 1, F.lit(8))), 16, -10).cast("bigint").alias("value"))

    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), read), lambda w: w["value"] != 0)


def _places(words: Column) -> Column:
    """The places of sorted words, in order."""
    def of(w: Column) -> Column:
        several = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda p: F.call_function("getbit", w["value"], _shift(p)) == 1)
        # Most words hold one place; a shift read as a place gives the place.
        inside = F.when(F.bit_count(w["value"]) == 1, F.array(_shift(F.length(F.bin(w["value"])) - 1))).otherwise(several)
        return F.transform(inside, lambda p: (w["word"] * 64 + p).cast("smallint"))

    return F.flatten(F.transform(words, of))


def _bitmap(words: Column) -> Column:
    """The bitmap of sorted words; those between them are empty."""
    def text(w: Column, i: Column) -> Column:
        before = F.coalesce(F.get(words, i - 1)["word"], F.lit(-1))
        return F.concat(F.repeat(F.lit("0" * 16), w["word"] - before - 1), F.lpad(F.hex(w["value"]), 16, "0"))

    return F.unhex(F.rpad(F.array_join(F.transform(words, text), ""), WORDS * 16, "0"))


def _gathered(words: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group of words: (keys, words, n)."""
    once = words.groupBy(*keys, "word").agg(F.bit_or("value").alias("value"))
    return once.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("word", "value"))).alias("words"), F.sum(F.bit_count("value")).alias("n"))


def order_sets(rows: DataFrame, by: tuple[str, ...] = ("sku_id",), window: str = "1 day", most_listed: int = MOST_LISTED) -> DataFrame:
    """The sets of product rows (``stats.product_rows``): stt, edt, the groups, kind, bucket, listed, bits.

    Rows without an order or a time belong to no set; a NULL group is a group.  Rows are dealt
    once, by bucket, and a bitmap is made where its rows are, so none crosses the exchange.
    """
    keys = ["window", *by, "kind", "bucket"]
    found = rows.filter(F.col("oid").isNotNull()).select(
        F.window("rt", window).alias("window"), *by, "kind", F.bitmap_bucket_number("oid").alias("bucket"),
        F.bitmap_bit_position("oid").cast("smallint").alias("place"))
    sets = _gathered(found.repartition(*keys).select(*keys, _word(F.col("place")).alias("w")).select(*keys, "w.*"), keys)
    few = F.col("n") <= most_listed
    return sets.select(
        stamp("window.start").alias("stt"), stamp("window.end").alias("edt"), *by, "kind", "bucket",
        F.when(few, _places(F.col("words"))).alias("listed"), F.when(~few, _bitmap(F.col("words"))).alias("bits"))


def unite(sets: DataFrame, by: list[str]) -> DataFrame:
    """One bitmap for each group of ``by``, kind and bucket: (by, kind, bucket, bits, n)."""
    keys = [*by, "kind", "bucket"]
    # The sets cross the exchange as they are and are opened after it; both later steps keep its partitioning.
    dealt = sets.select(*keys, "listed", "bits").repartition(*keys)
    words = F.when(F.col("listed").isNotNull(), F.transform("listed", _word)).otherwise(_words(F.col("bits")))
    united = _gathered(dealt.select(*keys, F.inline(words)), keys)
    return united.select(*keys, _bitmap(F.col("words")).alias("bits"), "n")


def distinct_orders(sets: DataFrame, by: list[str]) -> DataFrame:
    """How many different orders of each kind the groups of ``by`` hold, under the names of the product statistics."""
    counts = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint").alias(name) for name, kind in ORDER_KINDS.items()]
    return unite(sets, by).groupBy(*by).agg(*counts)
