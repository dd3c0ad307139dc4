"""The table graph: what each table is built from, in which order it is exported."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from graphlib import TopologicalSorter
from hashlib import md5
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitchlake.operators.watch import Watch
from pitchlake.plans import base, curated
from pitchlake.plans.contracts import CONTRACTS
from pitchlake.plans.settings import Settings
from pitchlake.session import hash_joins
from pitchlake.sinks.releases import Releases, read_if_there
from pitchlake.sinks.writers import export_csv, publish, write_table
from pitchlake.sources import layouts
from pitchlake.sources.snapshots import read_snapshots, read_table_csv, season_paths

# File of each raw source; those without season lie directly below the root.
SEASON_FILES = {
    "appearances": "appearances.json.gz",
    "games": "games.json.gz",
    "game_lineups": "game_lineups.json.gz",
    "players": "players.json.gz",
    "clubs": "clubs.json.gz",
    "national_teams": "national_teams.json.gz",
    "market_values": "market_values.json",
    "transfers": "transfers.json",
}
PLAIN_FILES = {"competitions": "competitions.json", "countries": "countries.json"}


@dataclass(frozen=True)
class Table:
    """Builder with the names of its inputs; ``raw.x`` is a source."""
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    order: tuple[str, ...] = ()
    with_settings: bool = False


def _base(build: Callable, *inputs: str) -> Table:
    return Table(inputs, build, with_settings=True)


def _curated(build: Callable, *inputs: str, order: tuple = ()) -> Table:
    return Table(inputs, build, order)


NEWEST = {
    "newest_games": _base(base.newest_games, "raw.games"),
    "newest_lineups": _base(base.newest_lineups, "raw.game_lineups"),
}

BASE = {
    "base_competitions": _base(base.competitions, "raw.competitions"),
    "base_countries": _base(base.countries, "raw.countries"),
    "base_national_teams": _base(base.national_teams, "raw.national_teams"),
    "base_clubs": _base(base.clubs, "raw.clubs"),
    "base_players": _base(base.players, "raw.players"),
    "base_games": _base(base.games, "newest_games", "newest_lineups"),
    "base_game_events": _base(base.game_events, "newest_games"),
    "base_game_lineups": _base(base.game_lineups, "newest_lineups"),
    "base_appearances": _base(base.appearances, "raw.appearances", "base_games"),
    "base_market_values": _base(base.market_values, "raw.market_values"),
    "base_transfers": _base(base.transfers, "raw.transfers"),
}

CURATED = {
    "competitions": _curated(curated.competitions, "base_competitions",
                             order=("competition_id",)),
    "countries": _curated(curated.countries, "base_countries", order=("country_id",)),
    "clubs": _curated(curated.clubs, "base_clubs", order=("club_id",)),
    "national_teams": _curated(curated.national_teams, "base_national_teams", "base_countries",
                               order=("national_team_id",)),
    "players": _curated(curated.players, "base_players", "base_clubs", "base_market_values",
                        order=("player_id",)),
    "games": _curated(curated.games, "base_games", "base_competitions", "base_clubs",
                      "base_game_events", order=("game_id",)),
    "club_games": _curated(curated.club_games, "base_games", order=("game_id", "club_id")),
    "appearances": _curated(curated.appearances, "base_appearances", "base_games",
                            "base_players", order=("date", "appearance_id")),
    "game_events": _curated(curated.game_events, "base_game_events", "base_games", order=(
        "game_id", "player_id", "club_id", "type", "minute", "coalesce(description, '')",
        "player_in_id", "player_assist_id")),
    "game_lineups": _curated(curated.game_lineups, "base_game_lineups", "base_games", order=(
        "game_id", "player_id", "position", "number", "team_captain", "type")),
    "player_valuations": _curated(curated.player_valuations, "base_market_values",
                                  "base_players", "base_clubs", "base_transfers",
                                  order=("date", "player_id")),
    "transfers": _curated(curated.transfers, "base_transfers", "base_players",
                          order=("transfer_date desc", "player_id")),
}


TABLES = {**NEWEST, **BASE, **CURATED}


def read_sources(spark: SparkSession, scraper_root: str, api_root: str, plain_root: str,
                 seasons: Iterable[int] | None = None, spread: int | None = None,
                 stored: Iterable[int] = ()) -> dict[str, DataFrame]:
    """All raw sources below their roots, as inputs of the graph.

    Seasons in ``stored`` have their responses in a release store, others in plain files; with
    ``stored``, the plain seasons are those that ``seasons`` names besides.
    """
    stored = list(stored)
    seasons = list(seasons) if seasons is not None else None
    responses = {s: Releases(spark, f"{api_root}/{s}").current() for s in stored}
    raw = {}
    for name, file in SEASON_FILES.items():
        if file.endswith(".gz"):
            paths = season_paths(scraper_root, file, seasons)
        else:
            plain = [s for s in seasons or [] if s not in responses] if stored else seasons
            paths = season_paths(api_root, file, plain) + [
                r[file] for r in responses.values() if file in r]
        raw[f"raw.{name}"] = read_snapshots(spark, paths, spread)
    for name, file in PLAIN_FILES.items():
        raw[f"raw.{name}"] = read_snapshots(spark, f"{plain_root}/{file}")
    return raw


def _edges(targets: Iterable[str]) -> dict[str, list[str]]:
    """Tables needed for the targets, each with the tables it reads."""
    edges: dict[str, list[str]] = {}
    waiting = list(targets)
    while waiting:
        name = waiting.pop()
        if name not in edges:
            edges[name] = [i for i in TABLES[name].inputs if i in TABLES]
            waiting += edges[name]
    return edges


def build_order(targets: Iterable[str] = tuple(CURATED)) -> list[str]:
    """Tables needed for the targets, inputs first."""
    return list(TopologicalSorter(_edges(targets)).static_order())


def _build(name: str, known: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    table = TABLES[name]
    inputs = [known[i] for i in table.inputs]
    return table.build(*inputs, settings) if table.with_settings else table.build(*inputs)


def plan(raw: Mapping[str, DataFrame], targets: Iterable[str] = tuple(CURATED),
         settings: Settings = Settings(),
         keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """DataFrames of the targets and of all tables below them.

    ``keep`` sees every table once it is planned and returns what later tables read: the
    plan itself by default, or a written copy.
    """
    known = dict(raw)
    built = {}
    for name in build_order(targets):
        built[name] = known[name] = keep(name, _build(name, known, settings))
    return built


def source_key(df: DataFrame) -> str:
    """What a source holds: its plan and the name, length and time of every file.

    A source without files has no such key and counts as new each time.
    """
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        return uuid.uuid4().hex
    known = df.sparkSession.read.format("binaryFile").load(files).select(
        F.xxhash64("path", "length", "modificationTime").alias("h"))
    return f"{df.semanticHash()} {len(files)} {known.agg(F.bit_xor('h')).first()[0]}"


def _code_key() -> str:
    """The code that tables are built with."""
    package = Path(__file__).resolve().parents[1]
    files = sorted(f for part in ("functions", "operators", "plans", "sources")
                   for f in (package / part).glob("*.py"))
    return md5(b"".join(f.read_bytes() for f in files)).hexdigest()


def table_keys(raw: Mapping[str, DataFrame], targets: Iterable[str] = tuple(CURATED),
               settings: Settings = Settings()) -> dict[str, str]:
    """Key of every table that is needed: equal keys mean equal code, settings and inputs."""
    order = build_order(targets)
    day = settings.as_of or date.today().isoformat()
    basis = f"{_code_key()} {settings!r} {day}"
    keys = {n: source_key(raw[n]) for n in {i for t in order for i in TABLES[t].inputs} & set(raw)}
    for name in order:
        inputs = " ".join(f"{i}={keys[i]}" for i in TABLES[name].inputs)
        keys[name] = md5(f"{basis} {name} {inputs}".encode()).hexdigest()
    return {name: keys[name] for name in order}


COUNTS = "name string, key string, check string, table string, column string, failures long"


class Run:
    """A build below a shared root that can be taken up where it ended.

    Every table is written once, under a key of all that it depends on, and marked as finished
    with the counts taken while it was written. A build with the same keys takes over what is
    finished; what a failed attempt has left of the others is overwritten. The tables of one
    build become the current release together, by one commit after the last of them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.releases = Releases(spark, f"{self.root}/release")

    def _path(self, name: str, key: str) -> str:
        return f"{self.root}/tables/{name}/{key}"

    def _marks(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.root}/finished", COUNTS)

    def finished(self, keys: Mapping[str, str]) -> set[str]:
        wanted = {(name, key) for name, key in keys.items()}
        marks = self._marks().select("name", "key").distinct().collect()
        return {r["name"] for r in marks if (r["name"], r["key"]) in wanted}

    def build(self, name: str, key: str, known: Mapping[str, DataFrame],
              settings: Settings) -> DataFrame:
        watch = Watch()
        df = write_table(_build(name, known, replace(settings, watch=watch)), self._path(name, key))
        counts = [("table", name, "*", 0), *watch.rows()]
        marks = self.spark.createDataFrame([(name, key, *c) for c in counts], COUNTS)
        marks.drop("name", "key").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/finished/name={name}/key={key}")
        return df

    def table(self, name: str, key: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name, key))

    def counts(self, keys: Mapping[str, str]) -> DataFrame:
        """Unreadable lines and cells of the build with these keys, as report rows."""
        one = F.concat_ws(" ", "name", "key").isin([f"{n} {k}" for n, k in keys.items()])
        return self._marks().filter(one & (F.col("check") != "table")).select(
            "check", "table", "column", F.lit("warn").alias("severity"), "failures",
            F.lit(None).cast("string").alias("detail"))


def run(raw: Mapping[str, DataFrame], root: str, targets: Iterable[str] = tuple(CURATED),
        settings: Settings = Settings(), threads: int = 4) -> dict[str, DataFrame]:
    """Build, write and release the tables below a shared folder; see ``Run``.

    Every table is written once and read back by the tables that follow, so raw text is
    parsed once per table and a lost executor costs at most the tables being written.
    Tables that do not depend on each other are submitted at the same time. A build that has
    failed goes on with the next call, and readers of ``released`` never see a part of one.
    """
    spark = next(iter(raw.values())).sparkSession
    here, keys = Run(spark, root), table_keys(raw, targets, settings)
    finished = here.finished(keys)
    known = dict(raw)
    built: dict[str, DataFrame] = {}
    graph = TopologicalSorter(_edges(targets))
    graph.prepare()
    with hash_joins(spark), ThreadPoolExecutor(threads) as pool:
        running = {}
        while graph.is_active():
            for name in graph.get_ready():
                work = (here.table, name, keys[name]) if name in finished else (
                    here.build, name, keys[name], known, settings)
                running[pool.submit(*work)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                built[name] = known[name] = future.result()
                graph.done(name)
    paths = {name: here._path(name, keys[name]) for name in built}
    if here.releases.current() != paths:
        here.releases.commit(paths)
    return built


def released(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the last complete build below a root."""
    return Run(spark, root).releases.tables()


def unreadable(raw: Mapping[str, DataFrame], root: str, targets: Iterable[str] = tuple(CURATED),
               settings: Settings = Settings()) -> DataFrame:
    """Counts of the build of these sources: report rows on lines and cells."""
    spark = next(iter(raw.values())).sparkSession
    return Run(spark, root).counts(table_keys(raw, targets, settings))


def quarantine(raw: Mapping[str, DataFrame], found: DataFrame) -> DataFrame | None:
    """The unreadable lines of those sources in which the build has found any.

    Only these are read again. None where every line could be read.
    """
    names = [r["table"] for r in found.filter(
        (F.col("check") == "unreadable_line") & (F.col("column") == "*")
        & (F.col("failures") > 0)).select("table").distinct().collect()]
    parts = [layouts.quarantine(raw[n], layouts.LAYOUTS[n], n) for n in sorted(names)]
    return reduce(DataFrame.unionByName, parts) if parts else None


def export(tables: Mapping[str, DataFrame], target: str, disabled: Iterable[str] = ()) -> None:
    """Gzip CSV of every curated table in its declared order."""
    disabled = set(disabled)
    for name, table in CURATED.items():
        if name in tables:
            export_csv(tables[name], f"{target}/{name}.csv.gz", table.order,
                       enabled=name not in disabled)


def publish_curated(tables: Mapping[str, DataFrame], target: str, commit: str) -> dict[str, str]:
    return publish({n: tables[n] for n in CURATED if n in tables}, target, commit)


def load(spark: SparkSession, target: str, name: str) -> DataFrame:
    """An exported table with the declared types; its columns must be the declared ones."""
    contract = CONTRACTS[name]
    path = f"{target}/{name}.csv.gz"
    header = spark.read.option("header", True).csv(path).columns
    typed = {f.name: f.spark_type for f in contract.fields}
    schema = T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in header])
    return contract.project(read_table_csv(spark, path, schema))
