"""Write gate: a failed acquisition must never replace good data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.sinks.releases import Releases

# Fixed value: highest accepted share of missing responses.
MAX_NULL_SHARE = 0.2


class RefusedWrite(RuntimeError):
    """The data is too poor to overwrite what is stored."""


def gate_verdict(df: DataFrame, missing: Column,
                 max_null_share: float = MAX_NULL_SHARE) -> DataFrame:
    """One row: records, missing ones, their share, and whether a write is allowed."""
    stats = df.agg(F.count("*").alias("total"), F.count_if(missing).alias("nulls"))
    share = F.when(F.col("total") > 0, F.col("nulls") / F.col("total"))
    return stats.withColumn("null_share", share).withColumn(
        "accepted", F.coalesce(F.col("null_share") <= max_null_share, F.lit(False)))


def check(df: DataFrame, missing: Column, label: str,
          max_null_share: float = MAX_NULL_SHARE) -> None:
    """Raise unless the records may be written. Fetches the single verdict row."""
    row = gate_verdict(df, missing, max_null_share).first()
    if row.total == 0:
        raise RefusedWrite(f"{label}: no records")
    if not row.accepted:
        raise RefusedWrite(f"{label}: {row.nulls} of {row.total} responses missing, "
                           f"more than {max_null_share:.0%}")


def guarded_write(releases: Releases, outputs: Mapping[str, DataFrame], missing: Column,
                  max_null_share: float = MAX_NULL_SHARE, tag: str = "") -> int:
    """Write all outputs as JSON lines and make them current together, or none of them.

    Outputs are written as new versions and what was written is checked, so a commit states
    exactly what passed the check, even when executors are lost or an output is also an input.
    Whatever fails before the commit leaves the old versions current. Returns its number.
    """
    paths = {}
    for name, df in outputs.items():
        paths[name] = releases.stage(name, lambda path: df.write.option(
            "ignoreNullFields", False).json(path))
        written = releases.spark.read.schema(df.schema).json(paths[name])
        check(written, missing, name, max_null_share)
    return releases.commit(paths, tag)
