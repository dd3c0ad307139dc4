"""Declared tables: fields, keys and relationships."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

FIELD_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "number": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "boolean": T.BooleanType(),
    "array": T.ArrayType(T.StringType()),
}


class ContractError(ValueError):
    """Columns differ from the declared ones."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    description: str | None = None
    tags: tuple[str, ...] = ()

    @property
    def spark_type(self) -> T.DataType:
        return FIELD_TYPES.get(self.type, T.StringType())


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str
    target: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    order: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(f.name, f.spark_type, True,
                          {"comment": f.description or "", "tags": list(f.tags)})
            for f in self.fields])

    def tagged(self, tag: str) -> list[str]:
        return [f.name for f in self.fields if tag in f.tags]

    def project(self, df: DataFrame) -> DataFrame:
        """Declared columns in declared order; any missing or extra column is an error."""
        wrong = set(df.columns) ^ set(self.columns)
        if wrong:
            raise ContractError(f"{self.name}: columns do not match: {sorted(wrong)}")
        return df.select(*self.columns)


def column_differences(df: DataFrame, declared: Sequence[str]) -> list[tuple[str, str]]:
    """Names on one side only, as (column, ``missing`` or ``extra``)."""
    missing = [(c, "missing") for c in declared if c not in df.columns]
    return missing + [(c, "extra") for c in df.columns if c not in declared]


def relationships(spark: SparkSession, contracts: Sequence[Contract]) -> DataFrame:
    """Declared foreign keys as rows ``(source, target, source_fields, target_fields)``."""
    rows = [(c.name, k.table, ",".join(k.columns), ",".join(k.target))
            for c in contracts for k in c.foreign_keys]
    return spark.createDataFrame(
        rows, "source string, target string, source_fields string, target_fields string")
