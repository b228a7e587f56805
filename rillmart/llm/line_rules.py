"""Quality rules: base counts of a text, and lines that too many documents of one host share.

Every line is normalised and hashed; per host the distinct texts that hold it are
counted.  Lines above the limit are cut, and a document that loses most of its
words to that is rejected.  All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, apart, let, stored, words_of

#: A line is too frequent in a host when more distinct texts than both of these hold it.
LEAST_TEXTS = 20
LEAST_SHARE = 0.1
#: A document is depleted when less than this share of its words is left.
LEAST_LEFT = 0.5


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more, each word counted once."""
    def covered(marks: Column) -> Column:
        def again(e: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(marks, i - 1)["h"] == e["h"])
            after = F.coalesce(F.get(marks, i + 1)["h"] == e["h"], F.lit(False))
            return F.when(before | after, e["i"])

        starts = F.array_sort(F.array_compact(F.transform(marks, again)))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("c"), F.lit(-3).alias("p")),
            lambda a, p: F.struct((a["c"] + F.least(F.lit(3), p - a["p"])).alias("c"), p.alias("p")), lambda a: a["c"])

    def count(hashes: Column) -> Column:
        marks = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(marks, covered))

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(words) < 3, 0).otherwise(let(windows(words), count)).cast("long")


def _normal(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(line, SPACE_CLASS + "+", " ")))


def _line_hash(line: Column) -> Column:
    """Hash of the normalised line; NULL for a line without a word."""
    return let(_normal(line), lambda n: F.when(n != "", F.xxhash64(n)))


def base_counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all long."""
    text = F.coalesce(text, F.lit(""))

    def lines(ls: Column) -> Column:
        full = F.filter(ls, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(full, lambda f: (F.size(f) - F.size(F.array_distinct(f))).cast("long"))

    return let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        lines(F.split(text, "\n")).alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words")))


def frequent_lines(docs: DataFrame, least_texts: int = LEAST_TEXTS, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, lines): per host the hashes of the lines above the limits; NULL is a host of its own.

    Copies of one text count once.  A line above the share fits in a host at most
    1 / least_share times the mean number of lines of a text, so the arrays stay short.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = F.array_distinct(F.array_compact(F.transform(F.split(text, "\n"), _line_hash)))
    texts = (docs.select(F.col("source").alias("host"), F.xxhash64(text).alias("a"), F.md5(text).alias("b"), hashes.alias("h"))
             .groupBy("host", "a", "b").agg(F.first("h").alias("h")))
    marked = texts.select("host", F.explode(F.concat("h", F.array(F.lit(None).cast("long")))).alias("line"))
    counts = marked.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    # The NULL line stands for the text itself, so its count is the host's number of distinct texts.
    counts = stored(counts.filter((F.col("n") > least_texts) | F.col("line").isNull()), "line-counts")
    hosts = counts.filter(F.col("line").isNull()).select(F.col("host").alias("host_"), F.col("n").alias("texts"))
    often = counts.filter(F.col("line").isNotNull()).join(hosts, F.col("host").eqNullSafe(F.col("host_")))
    often = often.filter(F.col("n") > F.col("texts") * least_share)
    return stored(often.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines")), "frequent-lines")


def line_rules(docs: DataFrame, least_texts: int = LEAST_TEXTS, least_share: float = LEAST_SHARE,
               least_left: float = LEAST_LEFT) -> DataFrame:
    """All columns of ``docs`` and a struct ``rules_``: the base counts, base_failed, words_left, kept and clean_text.

    NULL and empty texts have no words and fail the base rule.  A NULL source is a
    host like any other; repeated rows are judged alike; an empty table gives an
    empty table.  Whole texts are used whatever their length.
    """
    often = frequent_lines(docs, least_texts, least_share).withColumnRenamed("host", "host_").withColumnRenamed("lines", "often_")
    rows = docs.join(often, docs["source"].eqNullSafe(F.col("host_")), "left").drop("host_")
    # Through explode, so that a filter on the outcome stays above and the counts are worked out once.
    base = rows.select("*", F.explode(F.array(base_counts(docs["text"]))).alias("base_"))
    # Cut only where the host has frequent lines at all.
    cut = F.when(F.col("often_").isNotNull(), F.concat_ws("\n", F.filter(
        F.split(F.col("text"), "\n"),
        lambda x: ~F.coalesce(F.array_contains(F.col("often_"), _line_hash(x)), F.lit(False))))).otherwise(F.col("text"))
    base = base.withColumn("clean_", F.coalesce(cut, F.lit("")))
    b = F.col("base_")
    failed = (b["n_words"] < 50) | (b["n_repeat_words"] * 100 > b["n_words"] * 50)
    left = F.when(F.col("often_").isNull() | (F.col("clean_") == F.col("text")), b["n_words"]).otherwise(
        F.size(words_of(F.col("clean_"))).cast("long"))
    rules = F.struct(
        *[b[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), left.alias("words_left"),
        (~failed & (left >= b["n_words"] * least_left)).alias("kept"), F.col("clean_").alias("clean_text"))
    return base.select(*[docs[c] for c in docs.columns], rules.alias("rules_"))


def rules_report(docs: DataFrame) -> DataFrame:
    """The digest of the query: one row per document."""
    r = F.col("rules_")
    return line_rules(docs.select("doc_id", "text", "source")).select(
        "doc_id", *[r[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        r["base_failed"].alias("base_failed"), r["kept"].alias("kept"), r["words_left"].alias("words_left"))


@apart("doc_id", "text", "source", "n_chars")
def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their too frequent lines; n_chars follows the text."""
    r = F.col("rules_")
    kept = line_rules(docs).filter(r["kept"]).withColumn("text", r["clean_text"])
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.drop("rules_")
