"""Refresh of raw snapshots on disk."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.functions.text import last_token
from pitchlake.operators.gate import MAX_NULL_SHARE, guarded_write
from pitchlake.operators.merge import (
    JSON_FIELDS, TEXT_FIELDS, merge_asset, retry_overlay, supplement, within)
from pitchlake.session import scratch
from pitchlake.sinks.writers import export_json, write_table
from pitchlake.sinks.releases import Releases
from pitchlake.sources import records


def merge_snapshot(spark: SparkSession, new: str, old: str | None, asset: str, target: str,
                   quarantine: str | None = None) -> str:
    """Merge new records into the stored ones and write the result to a new path.

    Both sides are typed together, so a field whose type has changed since the old records
    were stored does not stop the merge. Lines that are no JSON objects go to ``quarantine``;
    without one they are an error, since the merge would lose them. The old files stay
    untouched; the caller points to ``target`` once it is complete.
    """
    sides = [records.read_variants(spark, path) for path in (new, old) if path]
    lost = reduce(DataFrame.union, [records.unreadable(side) for side in sides])
    if not lost.isEmpty():
        if quarantine is None:
            raise ValueError(f"{lost.count()} lines of {asset} are no JSON objects")
        lost.write.parquet(quarantine)
    if records.readable(sides[0]).isEmpty():
        raise ValueError(f"no new records of {asset} in {new}")
    forced = {*TEXT_FIELDS.get(asset, ()), *JSON_FIELDS.get(asset, ())}
    sides = [s for s in sides if not records.readable(s).isEmpty()]
    return export_json(merge_asset(*records.unite(sides, forced), asset=asset), target)


def supplement_competitions(spark: SparkSession, found: str, extra: str,
                            allowed: Iterable[str] | DataFrame, target: str) -> str:
    """Keep the allowed competitions that were found, add missing ones from a hand-written file.

    Competitions go by their code, the last part of their link. Both files are typed together,
    so hand-written fields may have another type. ``allowed`` is a list or, of any length, a table
    of codes. The result goes to a new path; a list that allows none of them is an error.
    """
    sides = records.unite([records.read_variants(spark, path) for path in (found, extra)])
    keyed = [side.withColumn("__code", last_token(F.col("href"))) for side in sides]
    kept = write_table(supplement(*keyed, "__code", allowed, [F.to_json(F.struct(*sides[0].columns))]),
                       scratch(spark, "supplemented"))
    if kept.isEmpty():
        raise ValueError(f"no allowed competition in {found} or {extra}")
    return export_json(kept.drop("__code"), target)


def player_ids(players: DataFrame, clubs: DataFrame | None = None,
               only_players: Iterable[str] | None = None, only_clubs: Iterable[str] | None = None,
               competitions: Iterable[str] | None = None) -> DataFrame:
    """Ids of the players to request: named ones, else those of clubs, else of leagues."""
    rows = players.select(last_token(F.col("href")).alias("id"),
                          last_token(F.col("parent.href")).alias("club"))
    if only_players:
        rows = rows.filter(F.col("id").isin(*only_players))
    elif only_clubs:
        rows = rows.filter(F.col("club").isin(*only_clubs))
    elif competitions:
        league = last_token(F.col("parent.href"))
        members = clubs.filter(league.isin(*competitions)).select(
            last_token(F.col("href")).alias("club"))
        rows = within(rows, members, "club", "club")
    return rows.select(F.col("id").try_cast("int").alias("player_id"))


VALUES_FILE, TRANSFERS_FILE = "market_values.json", "transfers.json"


def store_responses(market_values: DataFrame, transfers: DataFrame, requested: DataFrame,
                    releases: Releases, max_null_share: float = MAX_NULL_SHARE,
                    missing: Column | None = None) -> int:
    """Keep requested players, then store both response sets of a season or neither.

    ``releases`` is the store of the season below the root that ``read_sources`` reads.
    """
    missing = F.col("response").isNull() if missing is None else missing
    kept = within(transfers, requested, "player_id", "player_id")
    return guarded_write(releases, {VALUES_FILE: market_values, TRANSFERS_FILE: kept}, missing,
                         max_null_share)


def with_retries(first: DataFrame, retries: Iterable[DataFrame]) -> DataFrame:
    """Responses with the missing ones filled from each further attempt in turn."""
    for retry in retries:
        first = retry_overlay(first, retry, "player_id", "response")
    return first
