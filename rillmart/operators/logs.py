"""App log: new-visitor flag repair and the split into page, start and display logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("ts", "event_id")


def claims_new(log: DataFrame) -> DataFrame:
    return log.filter(F.col("common.is_new").eqNullSafe("1"))


def first_claims(log: DataFrame, order_by: tuple[str, ...] = ORDER) -> DataFrame:
    """Identity (mid and ordering columns) of each visitor's first record that claims to be new.

    The row number is limited on the map side, so a visitor with very many
    records sends one row per task.
    """
    w = Window.partitionBy("_mid").orderBy(*[f"_{c}" for c in order_by])
    ids = claims_new(log).select(F.col("common.mid").alias("_mid"), *[F.col(c).alias(f"_{c}") for c in order_by])
    return ids.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def repair_new_flag(log: DataFrame, claims: DataFrame | None = None,
                    order_by: tuple[str, ...] = ORDER, split: bool = True) -> DataFrame:
    """Only a visitor's first claim of ``is_new = '1'`` keeps it, later ones become ``'0'``.

    ``order_by`` must identify a record of a visitor.  Claiming records meet the
    first claims on their whole identity and not on the visitor alone, so the
    records of a very busy visitor spread over all tasks.  ``claims`` may hold the
    first claims of a larger log that ``log`` is a part of.

    With ``split`` records that claim nothing are read on their own and not
    shuffled at all; without it the log is computed only once, which pays where
    it is the result of other work.
    """
    claims = first_claims(log, order_by) if claims is None else claims
    same = F.col("common.mid").eqNullSafe(F.col("_mid"))
    for c in order_by:
        same = same & (F.col(c) == F.col(f"_{c}"))
    kept = F.col(f"_{order_by[0]}").isNotNull()
    flag = F.when(kept, "1").when(F.col("common.is_new").eqNullSafe("1"), "0").otherwise(F.col("common.is_new"))
    repaired = (
        (claims_new(log) if split else log).join(claims, same, "left")
        .withColumn("common", F.col("common").withField("is_new", flag))
        .select(*log.columns)
    )
    if not split:
        return repaired
    silent = log.filter(~F.col("common.is_new").eqNullSafe("1"))
    return repaired.unionByName(silent)


def start_log(log: DataFrame) -> DataFrame:
    return log.filter(F.col("start").isNotNull())


def page_log(log: DataFrame) -> DataFrame:
    return log.filter(F.col("start").isNull())


def display_log(log: DataFrame) -> DataFrame:
    """One row per display of the page records, with the page it was shown on."""
    return page_log(log).select(
        F.col("page.page_id").alias("page_id"), F.explode("displays").alias("d")).select("d.*", "page_id")


def split_log(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(page, start, display) logs of one parsed log."""
    return page_log(log), start_log(log), display_log(log)


def routed_log(log: DataFrame) -> DataFrame:
    """The same split as rows (sink_table, value) for a sink that writes all three at once.

    One pass over the log: each record becomes itself and, on pages, its displays.
    """
    record = [c for c in ("common", "page", "displays", "start", "ts", "event_id") if c in log.columns]
    is_page = F.col("start").isNull()
    own = F.struct(
        F.when(is_page, "dwd_page_log").otherwise("dwd_start_log").alias("sink_table"),
        F.to_json(F.struct(*record)).alias("value"))
    shown = F.transform(F.coalesce("displays", F.array()), lambda d: F.struct(
        F.lit("dwd_display_log").alias("sink_table"),
        F.to_json(d.withField("page_id", F.col("page.page_id"))).alias("value")))
    rows = F.when(is_page, F.concat(F.array(own), shown)).otherwise(F.array(own))
    return log.select(F.explode(rows).alias("r")).select("r.*")


def _entries(value: Column) -> Column:
    """The fields of a JSON object in text as a map; NULL for anything else."""
    return F.try_variant_get(F.try_parse_json(value), "$", "map<string,variant>")


def _with_text(entries: Column, name: str, text: Column) -> Column:
    """Set one field of an object to a text, or leave it out for NULL."""
    others = F.map_filter(entries, lambda k, _: k != name)
    return F.when(text.isNull(), others).otherwise(F.map_concat(others, F.create_map(F.lit(name), text.cast("variant"))))


def routed_whole(log: DataFrame, value: str = "value") -> DataFrame:
    """Rows (sink_table, value) like ``routed_log``, but each record whole, as its line ``value`` holds it.

    Only the repaired ``common.is_new`` is put in, and the page a display was shown
    on; every other field, listed in the schema or not, is handed on.
    """
    record = _entries(F.col(value))
    common = F.coalesce(F.try_variant_get(record["common"], "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    common = _with_text(common, "is_new", F.col("common.is_new"))
    whole = F.map_concat(F.map_filter(record, lambda k, _: k != "common"), F.create_map(F.lit("common"), F.to_variant_object(common)))
    is_page = F.col("start").isNull()
    own = F.struct(F.when(is_page, "dwd_page_log").otherwise("dwd_start_log").alias("sink_table"), F.to_json(whole).alias("value"))
    shown = F.coalesce(F.try_variant_get(record["displays"], "$", "array<variant>"), F.array().cast("array<variant>"))
    displays = F.transform(shown, lambda d: F.struct(
        F.lit("dwd_display_log").alias("sink_table"),
        F.to_json(_with_text(F.try_variant_get(d, "$", "map<string,variant>"), "page_id", F.col("page.page_id"))).alias("value")))
    rows = F.when(is_page, F.concat(F.array(own), displays)).otherwise(F.array(own))
    kept = [c for c in ("event_id",) if c in log.columns]
    return log.select(F.explode(rows).alias("r"), *kept).select("r.*", *kept)
