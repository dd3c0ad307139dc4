"""Picks of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

PICK = "__pick"


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One whole row per key: the first under ``order``, which has to be total.

    The limit of one is applied within each input task before the shuffle, so a key moves
    at most one row per task, however many rows it has.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(PICK, F.row_number().over(ranked)).filter(F.col(PICK) == 1).drop(PICK)


def newest_snapshot(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest season per key, then file name and line for equal seasons."""
    return latest(df, keys, F.desc("season"), F.desc("filename"), F.desc("line_hash"))


def newest_usable(df: DataFrame, keys: Sequence[str], usable: Column) -> DataFrame:
    """Newest season per key among usable rows: a failed newer snapshot never hides an older."""
    return newest_snapshot(df.filter(usable), keys)


def any_value_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key, the smallest for a repeatable result."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def current_and_peak(df: DataFrame, key: str, when: Sequence[str], value: str,
                     current: str, peak: str) -> DataFrame:
    """Value at the latest point and highest value per key in one aggregation."""
    return df.groupBy(key).agg(
        F.max_by(value, F.struct(*when, value)).alias(current),
        F.max(value).alias(peak))
