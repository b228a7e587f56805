"""Mix sources to target weights: repetition rates per source, then whole copies plus one drawn copy.

A document is taken floor(rate) times, and once more with probability rate - floor(rate),
drawn from a hash of its id.  One of DRAWS hash seeds is chosen per source: the one whose
total lies nearest the target.  So reruns agree and small sources hit their target too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, buckets_for, stored, words_of

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
DRAWS = 32


def _draw(doc_id: Column, k: Column) -> Column:
    """A number in [0, 1) from the id and the seed: 32 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.floor(k / 4).cast("string")))
    return F.conv(F.substring(digest, (k % 4) * 8 + 1, F.lit(8)), 16, 10).cast("double") / float(2 ** 32)


def _running(rows: DataFrame, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """Sums over all rows before a row in an order; no task takes all rows, only a row per range of them."""
    placed = stored(rows.repartitionByRange(buckets_for(rows.sparkSession), *order).withColumn("part_", F.spark_partition_id()), label)
    ahead = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part_").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = totals.select("part_", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"{n}_") for n in sums])
    inside = Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(before, "part_").select(
        *rows.columns, *[(F.col(f"{n}_") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()])


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source, NULL a source of its own.

    Weights repeat over the sources by code point, NULL last.  Targets share the
    total by weight and stop at MOST_REPEATS times the source's size, the excess
    shared by the others: all follow one level, target = least(stop, weight * level).
    In the order of stop over weight the level lies before the first source at
    whose own level the targets would reach the total; running sums tell which.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = [F.col("source").isNull(), F.col("source").cast("binary")]
    ranked = _running(per, by_name, {"rank": F.lit(1)}, "source-ranges")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    per = stored(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    total, weights = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    stop = F.col("source_size") * MOST_REPEATS
    at = (stop / F.col("weight")).alias("at")
    levels = _running(per.select("source", "source_size", "weight", at), [F.col("at"), *by_name], {"stopped": stop, "passed": F.col("weight")}, "source-levels")
    reached = F.col("stopped") + F.col("at") * (F.lit(weights) - F.col("passed")) >= F.lit(total)
    share = (F.lit(total) - F.col("stopped")) / (F.lit(weights) - F.col("passed"))
    level = levels.filter(reached).agg(F.min(F.struct("at", share.alias("level")))["level"]).first()[0] or 0.0
    return per.select("source", "source_size", F.least(stop.cast("double"), F.col("weight") * F.lit(float(level))).alias("target"))


def _with_sources(rows: DataFrame, per: DataFrame) -> DataFrame:
    """Attach the source's row.  The table is small or Spark splits the hot source's rows; both keep every row."""
    per = per.withColumnRenamed("source", "source_of_")
    return rows.join(per, F.col("source_key_").eqNullSafe(F.col("source_of_")), "left").drop("source_of_")


def mix_plan(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and a struct ``mix_``: size, source_size, target, copies.

    A NULL or empty text has size 0 and is copied like the rest of its source; a
    source of size 0 has target 0 and is taken no time.  Repeated rows share one
    draw.  An empty table gives an empty table.
    """
    size = F.size(words_of(F.col("text"))).cast("long")
    ids = stored(docs.select(F.col("doc_id").alias("doc_key_"), F.col("source").alias("source"), size.alias("size")), "sizes")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole, part = F.floor(rate), rate - F.floor(rate)
    targets = source_targets(ids)
    draws = _with_sources(ids.withColumnRenamed("source", "source_key_"), targets)
    sums = [F.sum(F.col("size") * (whole + (_draw(F.col("doc_key_"), F.lit(k)) < part).cast("int"))) for k in range(DRAWS)]
    totals = draws.groupBy(F.col("source_key_").alias("source"), "source_size", "target").agg(F.array(*sums).alias("sums"))
    misses = F.transform("sums", lambda s, k: F.struct(F.abs(s - F.col("target")).alias("miss"), k.alias("k")))
    chosen = stored(totals.select("source", "source_size", "target", F.array_min(misses)["k"].alias("seed")), "mix-seeds")
    rows = _with_sources(docs.withColumn("source_key_", F.col("source")), chosen.select(
        F.col("source"), F.struct("source_size", "target", "seed").alias("plan_")))
    p = F.col("plan_")
    rate = F.when(p["source_size"] > 0, p["target"] / p["source_size"]).otherwise(0.0)
    copies = F.floor(rate) + (_draw(F.col("doc_id"), p["seed"]) < rate - F.floor(rate)).cast("long")
    return rows.withColumn("mix_", F.struct(
        size.alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"),
        copies.cast("long").alias("copies"))).select(*[docs[c] for c in docs.columns], "mix_")


@apart("doc_id", "text", "source")
def mix(docs: DataFrame) -> DataFrame:
    """The mixture itself: every document as often as the plan takes it."""
    return mix_plan(docs).filter(F.col("mix_.copies") > 0).withColumn(
        "copy_", F.explode(F.sequence(F.lit(1), F.col("mix_.copies").cast("int")))).drop("mix_", "copy_")


def mix_report(docs: DataFrame) -> DataFrame:
    m = F.col("mix_")
    return mix_plan(docs.select("doc_id", "text", "source")).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["size"] * m["copies"]).alias("taken"))
