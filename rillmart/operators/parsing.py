"""JSON records and change envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import loose_long

CORRUPT = "_corrupt"


def text_schema(kind: T.DataType) -> T.DataType:
    """The same nesting with text in place of every number, flag and time."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, text_schema(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(text_schema(kind.elementType))
    return kind if isinstance(kind, T.MapType) else T.StringType()


def from_texts(value: Column, kind: T.DataType) -> Column:
    """Text leaves in their own types; what is none of that type is NULL."""
    if isinstance(kind, T.StructType):
        fields = F.struct(*[from_texts(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: from_texts(x, kind.elementType))
    if isinstance(kind, (T.MapType, T.StringType)):
        return value
    return loose_long(value) if isinstance(kind, T.LongType) else value.try_cast(kind)


def parse_marked(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = (),
                 value: str = "value") -> DataFrame:
    """Parse JSON lines into the schema's columns plus a flag ``dirty``.

    Dirty are lines that are no JSON object of this nesting, blank lines, and
    records without a required field.  Numbers may be quoted or have decimals: a
    whole number takes the part before the point.  Fields outside the schema stay
    in ``value``.  The record passes through ``explode`` so that filters on the
    outcome stay above the parse, which then runs once.
    """
    full = T.StructType([*text_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(value, full, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    parsed = lines.select("*", F.explode(F.array(record)).alias("_r"))
    dirty = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    typed = parsed.select(
        *lines.columns, *[from_texts(F.col(f"_r.{f.name}"), f.dataType).alias(f.name) for f in schema.fields], dirty.alias("dirty"))
    for field in required:
        typed = typed.withColumn("dirty", F.col("dirty") | F.col(field).isNull())
    return typed


def parse_lines(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = (),
                value: str = "value", keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, dirty lines) of JSON lines; with ``keep`` records hold their line."""
    marked = parse_marked(lines, schema, required, value)
    good = marked.filter(~F.col("dirty")).drop("dirty", *([] if keep else [value]))
    return good, marked.filter("dirty").select(*lines.columns)


def to_json_lines(df: DataFrame) -> DataFrame:
    """Rows -> JSON lines ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def change_envelope(records: DataFrame) -> DataFrame:
    """Raw change records (topic ``a.database.table``, op, before, after) in the common envelope.

    Created and snapshot rows both become ``insert``; an absent image becomes an
    empty map.  Other columns, such as a sequence number, pass through.
    """
    op = F.lower("op")
    empty = F.create_map().cast("map<string,string>")
    path = F.split("topic", r"\.")
    rest = [c for c in records.columns if c not in ("topic", "op", "before", "after")]
    return records.select(
        path[1].alias("database"),
        path[2].alias("tableName"),
        F.coalesce("before", empty).alias("before"),
        F.coalesce("after", empty).alias("after"),
        F.when(op.isin("create", "read"), "insert").otherwise(op).alias("type"),
        *rest,
    )


def flat_envelope(records: DataFrame) -> DataFrame:
    """The flat form: operation as it is, the new image only; deletes carry none and are left out."""
    path = F.split("topic", r"\.")
    rest = [c for c in records.columns if c not in ("topic", "op", "before", "after")]
    return records.filter(F.col("after").isNotNull()).select(
        F.lower("op").alias("operation"),
        F.col("after").alias("data"),
        path[1].alias("database"),
        path[2].alias("table"),
        *rest,
    )
