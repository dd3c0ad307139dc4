"""Refresh of stored snapshots: merge, overlay, supplement and scope."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.functions.keys import NULL_MARK, joined_key
from pitchlake.functions.text import last_token
from pitchlake.operators.contract import Contract, ForeignKey
from pitchlake.operators.snapshot import latest

# Fields whose inferred type drifts between snapshots, by asset.
TEXT_FIELDS = {
    "clubs": ["coach_name", "coach_href", "total_market_value", "league_position"],
    "games": ["home_club_position", "away_club_position"],
    "players": ["day_of_last_contract_extension", "current_market_value", "highest_market_value"],
    "national_team_players": ["day_of_last_contract_extension", "current_market_value",
                              "highest_market_value"],
}
JSON_FIELDS = {
    "clubs": ["parent"],
    "players": ["parent"],
    "games": ["parent"],
    "game_lineups": ["parent"],
    "appearances": ["parent"],
    "national_team_players": ["parent"],
}


def _nested(df: DataFrame, parent: str, field: str) -> Column:
    """A nested field, whether the parent is a struct or was forced to JSON text."""
    if df.schema[parent].dataType.typeName() == "struct":
        return F.col(f"{parent}.{field}")
    return F.get_json_object(parent, f"$.{field}")


def record_key(df: DataFrame, asset: str) -> Column:
    """Key of a record within its asset; missing parts are marked, NULL if all are missing."""
    if asset == "appearances":
        parts = [_nested(df, "parent", "href"), *map(F.col, ("competition_code", "matchday", "date"))]
        marked = joined_key(*[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts])
        return F.when(F.coalesce(*[p.cast("string") for p in parts]).isNotNull(), marked)
    return F.col("href")


def upsert(new: DataFrame, old: DataFrame | None, keys: Mapping[str, Column] | Sequence[str],
           tie: Sequence[Column] = ()) -> DataFrame:
    """Union by name in which a new record replaces the old one of the same key.

    Without an old side the new records pass through as they are.
    """
    if old is None:
        return new
    if not isinstance(keys, Mapping):
        keys = {c: F.col(c) for c in keys}
    marked = {f"__k{i}": key for i, key in enumerate(keys.values())}
    rows = new.withColumn("__new", F.lit(1)).unionByName(
        old.withColumn("__new", F.lit(0)), allowMissingColumns=True)
    rows = rows.withColumns(marked)
    kept = latest(rows, list(marked), F.desc("__new"), *tie)
    return kept.drop("__new", *marked)


def merge_asset(new: DataFrame, old: DataFrame | None = None, *, asset: str) -> DataFrame:
    """Upsert of typed records of one asset; records without any key are all kept, once each."""
    if old is None:
        return new
    rows = new.select(F.lit(1).alias("__new"), "*", record_key(new, asset).alias("__key"))
    past = old.select(F.lit(0).alias("__new"), "*", record_key(old, asset).alias("__key"))
    both = rows.unionByName(past, allowMissingColumns=True)
    content = F.xxhash64(F.to_json(F.struct(*[c for c in both.columns if c != "__new"])))
    both = both.withColumn("__content", content).withColumn(
        "__alone", F.when(F.col("__key").isNull(), F.col("__content")))
    return latest(both, ["__key", "__alone"], F.desc("__new"), F.asc("__content")).drop(
        "__new", "__key", "__content", "__alone")


def retry_overlay(first: DataFrame, retry: DataFrame, key: str, value: str) -> DataFrame:
    """Fill missing values from a second attempt; values already there stay.

    Of several answers to a key, the first by its JSON text counts, so rows never multiply.
    """
    text = F.to_json(F.struct(value))
    again = retry.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(
        F.min_by(value, text).alias("__again"))
    return first.join(again, key, "left").withColumn(
        value, F.coalesce(value, "__again")).drop("__again")


def supplement(found: DataFrame, extra: DataFrame, key: str,
               allowed: Column | DataFrame | Iterable, tie: Sequence[Column]) -> DataFrame:
    """Allowed records, plus hand-written ones that are allowed and not found already.

    ``allowed`` is a condition, a short list of keys, or a table whose first column holds the
    keys, of any length.
    """
    def in_scope(rows: DataFrame) -> DataFrame:
        if isinstance(allowed, DataFrame):
            return within(rows, allowed, key, allowed.columns[0])
        listed = isinstance(allowed, Column)
        return rows.filter(allowed if listed else F.col(key).isin(*list(allowed)))

    kept = in_scope(found)
    added = latest(in_scope(extra).join(kept.select(key), key, "left_anti"), [key], *tie)
    return kept.unionByName(added, allowMissingColumns=True)


def within(df: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child records whose parent is in scope."""
    scope = parents.select(F.col(parent_key).alias(child_key))
    return df.join(scope, child_key, "left_semi")


def without(df: DataFrame, others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Records without partner; NULL keys have none."""
    return df.join(others.select(*on), list(on), "left_anti")


def only_ids(df: DataFrame, column: Column, ids: Iterable, what: str) -> DataFrame:
    """Records with one of the given ids; a filter that matches nothing is an error."""
    kept = df.filter(column.isin(*list(ids)))
    if kept.isEmpty():
        raise ValueError(f"filter matched no record in {what}")
    return kept


def scope_chain(assets: Mapping[str, DataFrame], competitions: Iterable[str] | None = None,
                clubs: Iterable[str] | None = None,
                players: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Restrict raw records (typed, with ``href`` and ``parent.href``) to a part of the world.

    A restriction on competitions reaches clubs and games, then players and lineups,
    then appearances; one on clubs or players starts further down.
    """
    out = dict(assets)
    frames = {name: df.withColumn("__id", last_token(F.col("href")))
              .withColumn("__parent", last_token(F.col("parent.href")))
              for name, df in assets.items()}

    def limit(child: str, parent: str) -> None:
        if child in frames:
            frames[child] = within(frames[child], frames[parent], "__parent", "__id")
            out[child] = frames[child].select(*assets[child].columns)

    def start(name: str, ids: Iterable[str]) -> None:
        frames[name] = only_ids(frames[name], F.col("__id"), ids, name)
        out[name] = frames[name].select(*assets[name].columns)

    if competitions:
        start("competitions", competitions)
        limit("clubs", "competitions")
        limit("games", "competitions")
        if "game_lineups" in frames and "games" in frames:
            lineups = within(frames["game_lineups"], frames["games"], "__id", "__id")
            out["game_lineups"] = lineups.select(*assets["game_lineups"].columns)
    elif clubs:
        start("clubs", clubs)
    if players:
        start("players", players)
    elif competitions or clubs:
        limit("players", "clubs")
    limit("appearances", "players")
    return out


def scope_closure(tables: Mapping[str, DataFrame], contracts: Iterable[Contract],
                  start: Mapping[str, Column | DataFrame]) -> dict[str, DataFrame]:
    """Restrict tables to what depends on a part of some of them.

    ``start`` names tables with a condition, or with a table of the key values to keep. Every
    table that declares a relationship to a restricted one, directly or over others, keeps the
    rows of which at least one such relationship leads to a row that is kept. Tables that
    nothing restricted is declared for stay whole.
    """
    links = [(c.name, key) for c in contracts for key in c.foreign_keys
             if c.name in tables and key.table in tables and c.name != key.table]
    reached, waiting = set(start), list(start)
    while waiting:
        parent = waiting.pop()
        new = {child for child, key in links if key.table == parent} - reached
        reached |= new
        waiting += new
    parents = {name: {key.table for child, key in links if child == name and key.table in reached}
               for name in reached - set(start)}
    out = dict(tables)
    for name in TopologicalSorter({**{s: () for s in start}, **parents}).static_order():
        if name not in start:
            own = [key for child, key in links if child == name and key.table in reached]
            out[name] = _linked(tables[name], own, out)
        elif isinstance(start[name], DataFrame):
            out[name] = tables[name].join(start[name], start[name].columns, "left_semi")
        else:
            out[name] = tables[name].filter(start[name])
    return out


def _linked(df: DataFrame, keys: Sequence[ForeignKey], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of which at least one key leads to a row of its parent."""
    joined, marks = df, []
    for i, key in enumerate(keys):
        names = [f"__p{i}_{j}" for j in range(len(key.columns))]
        there = parents[key.table].select(
            *[F.col(t).alias(n) for t, n in zip(key.target, names)]).distinct()
        joined = joined.join(there.withColumn(f"__there{i}", F.lit(True)),
                             [F.col(c) == F.col(n) for c, n in zip(key.columns, names)], "left")
        marks.append(F.col(f"__there{i}"))
    return joined.filter(F.coalesce(*marks)).select(*df.columns)
