"""Words of a text by a dictionary that is a table.

A text is cut at punctuation into runs and a run into units: single Han characters, or letters and digits of one
script (``functions.text``).  Positions of a run are its units and the gaps of white space between them, and a dictionary word is a stretch
of positions that begins and ends with a unit, so ``phone case`` and words of several Han characters are found and
``art`` is not found in ``party``.  White space counts as one blank, case is ignored.

* ``all``: every dictionary word at every position, overlapping ones too, and each unit that lies in none of them.
* ``longest``: from left to right the longest dictionary word at a position, going on behind it; a unit where none begins is a word.

All of it is joins and windows.  Each distinct run is looked up once, however often it occurs.  A run's stretches up to the
dictionary's longest word meet the dictionary by equality; the longest matches are chosen within islands of matches that
overlap, so what is handled in one row is an island and not a text; the time an island takes grows with the square of its matches.

Texts that are NULL, empty or without a unit have no words; NULL and repeated dictionary words count for nothing.
An empty dictionary leaves the units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WORD_PATTERN

MODES = ("all", "longest")
RUN_PATTERN = r"([\p{L}\p{M}\p{N}\sー]+)"
_GAP = " "
#: Positions whose stretches are made at once, so that a long run is many rows.
PIECE = 500


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", _GAP))


def _positions(run: Column) -> Column:
    return F.regexp_extract_all(run, F.lit(f"{WORD_PATTERN}|\\s"), F.lit(0))


def _dictionary(words: DataFrame) -> DataFrame:
    """Distinct words as they are matched, with their number of positions."""
    plain = words.select(_plain(F.col("word")).alias("word")).filter("word <> ''").distinct()
    return plain.withColumn("n", F.size(_positions(F.col("word"))))


def _matches(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, s, n, word): dictionary words by where they begin."""
    longest = words.agg(F.max("n")).first()[0]
    if longest is None:
        return runs.select("run", F.lit(0).alias("s"), F.lit(0).alias("n"), F.lit("").alias("word")).limit(0)
    offsets = F.sequence(F.lit(0), F.size("at") - 1, F.lit(PIECE))
    pieces = runs.select("run", F.explode(F.transform(offsets, lambda o: F.struct(
        o.alias("o"), F.slice("at", o + 1, F.lit(PIECE + longest - 1)).alias("at")))).alias("p")).select("run", "p.*")

    def stretches(i: Column) -> Column:
        ends = F.sequence(i, F.least(i + (longest - 1), F.size("at")))
        ends = F.filter(ends, lambda e: (F.get("at", i - 1) != _GAP) & (F.get("at", e - 1) != _GAP))
        return F.transform(ends, lambda e: F.struct((F.col("o") + i).alias("s"), (e - i + 1).alias("n"),
                                                    F.array_join(F.slice("at", i, e - i + 1), "").alias("word")))

    begins = F.sequence(F.lit(1), F.least(F.lit(PIECE), F.size("at")))
    tried = pieces.select("run", F.explode(F.flatten(F.transform(begins, stretches))).alias("t")).select("run", "t.*")
    return tried.join(words.select("word", "n"), ["word", "n"]).select("run", "s", "n", "word")


def _longest_path(matches: DataFrame) -> DataFrame:
    """The matches a reader from left to right takes, each time the longest."""
    ends = matches.groupBy("run", "s").agg(F.max(F.struct("n", "word")).alias("m")).select("run", "s", (F.col("s") + F.col("m.n")).alias("e"), "m.n", "m.word")
    before = Window.partitionBy("run").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("run").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    opens = (F.col("s") >= F.coalesce(F.max("e").over(before), F.lit(0))).cast("int")
    islands = ends.withColumn("opens", opens).withColumn("island", F.sum("opens").over(upto))
    rows = islands.groupBy("run", "island").agg(F.sort_array(F.collect_list(F.struct("s", "e", "n", "word"))).alias("ms"))
    none = F.slice("ms", 1, 0)
    taken = F.aggregate("ms", F.struct(F.lit(0).alias("e"), none.alias("out")), lambda acc, m: F.when(
        m["s"] >= acc["e"], F.struct(m["e"].alias("e"), F.concat(acc["out"], F.array(m)).alias("out"))).otherwise(acc), lambda acc: acc["out"])
    return rows.select("run", F.explode(taken).alias("m")).select("run", "m.s", "m.n", "m.word")


def run_words(runs: DataFrame, dictionary: DataFrame, mode: str = "all") -> DataFrame:
    """(run, word, times) of distinct runs, a column ``run``."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    words = _dictionary(dictionary)
    # A run goes by its digest, as it may be a long text.  The explode of one value keeps its positions from being found again wherever they are used.
    cut = runs.select(F.sha2("run", 256).alias("run"), F.explode(F.array(_positions(F.col("run")))).alias("at")).filter(F.size("at") > 0)
    found = _matches(cut, words)
    if mode == "longest":
        found = _longest_path(found)
    covered = found.select("run", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1)).alias("s")).distinct()
    units = cut.select("run", F.posexplode("at").alias("p", "word")).select("run", (F.col("p") + 1).alias("s"), "word").filter(F.col("word") != _GAP)
    alone = units.join(covered, ["run", "s"], "left_anti")
    return found.select("run", "word").unionByName(alone.select("run", "word")).groupBy("run", "word").agg(F.count(F.lit(1)).alias("times"))


def text_runs(text: Column) -> Column:
    """The runs of a text, in order, repeats kept."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(RUN_PATTERN), F.lit(1)), _plain)
    return F.filter(runs, lambda r: r != "")


def words_of(texts: DataFrame, text: str, dictionary: DataFrame, mode: str = "all") -> DataFrame:
    """(text, word, times): the words of each distinct text and how often it holds them; ``dictionary`` has a column ``word``."""
    per_run = texts.select(F.col(text).alias("_text")).filter("_text is not null").distinct().select("_text", F.explode(text_runs(F.col("_text"))).alias("run"))
    found = run_words(per_run.select("run").distinct(), dictionary, mode)
    joined = per_run.select("_text", F.sha2("run", 256).alias("run")).join(found, "run")
    return joined.groupBy("_text", "word").agg(F.sum("times").alias("times")).withColumnRenamed("_text", text)
