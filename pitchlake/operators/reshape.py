"""Nested lists and side-by-side columns to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def explode_list(df: DataFrame, items: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per list element; a missing or empty list gives none."""
    if position:
        return df.select("*", F.posexplode(items).alias(position, name))
    return df.select("*", F.explode(items).alias(name))


def explode_json(df: DataFrame, json_list: Column, name: str) -> DataFrame:
    """One row per element of a JSON list, elements as JSON text."""
    return explode_list(df, F.from_json(json_list, "array<string>"), name)


def explode_distinct(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per distinct element of each row's list, without a shuffle."""
    return explode_list(df, F.array_distinct(items), name)


def sides(df: DataFrame, legs: Sequence[Mapping[str, Column]], keep: Sequence[str]) -> DataFrame:
    """One row per leg from a single scan; all legs name the same columns in the same order."""
    rows = F.explode(F.array(*[
        F.struct(*[column.alias(name) for name, column in leg.items()]) for leg in legs]))
    return df.select(*keep, rows.alias("leg")).select(*keep, "leg.*")


def two_sided(df: DataFrame, keep: Sequence[str], pairs: Mapping[str, tuple[str, str]],
              names: Mapping[str, tuple[str, str]], tag: str,
              labels: tuple[str, str]) -> DataFrame:
    """Every row twice, seen from either side.

    ``pairs`` maps a measure to its two source columns, ``names`` the measure to its
    output names for the own and for the opposing side.
    """
    def leg(own: int) -> dict[str, Column]:
        other = 1 - own
        columns = {names[m][0]: F.col(pair[own]) for m, pair in pairs.items()}
        columns |= {names[m][1]: F.col(pair[other]) for m, pair in pairs.items()}
        return columns | {tag: F.lit(labels[own])}

    return sides(df, [leg(0), leg(1)], keep)
