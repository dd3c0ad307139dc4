"""JSON records whose fields change their type between snapshots.

Every line is parsed once into a VARIANT, which holds any JSON value as it is. The types of all
sides are united before anything is cast: numbers widen, objects take the fields of both, and
what cannot be united (a number here and text there, an object or a list here and a scalar
there) becomes text at the depth where it differs, objects and lists as JSON text. One cast
then types whole records, so records of different age can be united by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitchlake.session import scratch
from pitchlake.sinks.writers import write_table


def read_variants(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows ``(record, value, filename)``, stored; ``record`` is NULL for an unreadable line.

    A record is a JSON object. ``value`` keeps the line of what is not, for the quarantine.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("filename"))
    parsed = F.when(F.col("value").rlike(r"^\s*\{"), F.try_parse_json("value"))
    rows = lines.filter(F.length(F.trim("value")) > 0).select(
        parsed.alias("record"), "value", "filename")
    kept = rows.withColumn("value", F.when(F.col("record").isNull(), F.col("value")))
    return write_table(kept, scratch(spark, "records"))


def readable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("record").isNotNull()).select("record")


def unreadable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("record").isNull()).select("value", "filename")


def _plain(kind: T.DataType) -> T.DataType:
    """The type with text for what has no common type, no value or no field."""
    if isinstance(kind, T.StructType) and kind.fields:
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, (T.StructType, T.VariantType, T.NullType)):
        return T.StringType()
    return kind


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{', '.join(fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def united_type(sides: Sequence[DataFrame], text: Iterable[str] = ()) -> T.StructType:
    """Type that the records of all sides can be cast to; ``text`` fields are text in any case."""
    both = reduce(DataFrame.union, [readable(side) for side in sides])
    found = both.agg(F.schema_of_variant_agg("record")).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType([])
    named = re.sub(r"`(?:[^`]|``)*`|OBJECT<",
                   lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    forced = set(text)
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in forced else _plain(f.dataType))
        for f in T.DataType.fromDDL(named).fields])


def typed(rows: DataFrame, kind: T.StructType) -> DataFrame:
    """Readable records as columns; fields a record lacks are NULL."""
    if not kind.fields:
        return readable(rows).select()
    record = F.try_variant_get("record", F.lit("$"), _ddl(kind))
    # The generator casts once; as plain columns every field would cast the record again.
    return readable(rows).select(F.inline(F.array(record)))


def unite(sides: Sequence[DataFrame], text: Iterable[str] = ()) -> list[DataFrame]:
    """All sides with one type."""
    kind = united_type(sides, text)
    return [typed(side, kind) for side in sides]
