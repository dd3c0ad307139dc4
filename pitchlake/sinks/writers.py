"""Materialised tables, exports and the published set."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.sinks.releases import Releases


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Full overwrite as parquet, read back so that later plans start from the written table."""
    spark = df.sparkSession
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Full overwrite as a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """Total order for export by range-partitioned sort, NULLs last in both directions.

    Keys are expressions, descending ones end in `` desc``.
    """
    keys = []
    for key in order:
        name, _, direction = key.rpartition(" ")
        down = direction == "desc" and bool(name)
        column = F.expr(name if down else key)
        keys.append(column.desc_nulls_last() if down else column.asc_nulls_last())
    return df.orderBy(*keys)


def export_csv(df: DataFrame, path: str, order: Iterable[str] = (),
               enabled: bool = True) -> str | None:
    """Gzip CSV with header, one file per range of the order; names sort like the rows."""
    if not enabled:
        return None
    order = list(order)
    out = in_order(df, *order) if order else df
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(path))
    return path


def export_json(df: DataFrame, path: str) -> str:
    """Gzip JSON lines."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return path


def version_table(spark: SparkSession, commit: str) -> DataFrame:
    return spark.sql("select :commit as commit_hash", args={"commit": commit})


def publish(tables: Mapping[str, DataFrame], target: str, commit: str) -> dict[str, str]:
    """Copy tables and a one-row ``version`` below a target; returns path by table.

    All of them become current together: until then readers of the target find the tables
    that were published before.
    """
    spark = next(iter(tables.values())).sparkSession
    releases = Releases(spark, target)
    paths = {name: releases.stage(name, df.write.parquet)
             for name, df in {**tables, "version": version_table(spark, commit)}.items()}
    releases.commit(paths, commit)
    return paths
