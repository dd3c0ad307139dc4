"""Sources, sinks and publication."""

import pytest

from pitchlake.plans.contracts import CONTRACTS
from pitchlake.plans.warehouse import export, load, publish_curated
from pitchlake.sinks import writers
from pitchlake.sinks.releases import Releases
from pitchlake.sources import snapshots


def test_expand_seasons():
    assert snapshots.expand_seasons("2012-2014") == [2012, 2013, 2014]
    assert snapshots.expand_seasons("2012") == [2012]
    for bad in ("2000-2030", "1-2-3", "", "x"):
        with pytest.raises(ValueError):
            snapshots.expand_seasons(bad, most=20)
    assert len(snapshots.expand_seasons("2000-2030")) == 31


def test_raw_lines_keep_season_and_file(raw):
    rows = raw["raw.players"].groupBy("season").count().collect()
    assert {r.season: r["count"] for r in rows} == {2023: 2, 2024: 4}
    assert raw["raw.players"].first().filename.endswith("players.json.gz")
    # The blank last line of a file is not a record.
    assert raw["raw.competitions"].count() == 4
    assert raw["raw.competitions"].first().season is None


def test_only_named_seasons_are_read(spark, raw, tmp_path):
    root = raw["raw.players"].first().filename.rsplit("/", 2)[0]
    one = snapshots.read_snapshots(spark, snapshots.season_paths(root, "players.json.gz", [2023]), 2)
    assert one.count() == 2


def test_order_puts_nulls_last(spark):
    df = spark.sql("select * from values (1, 'b'), (null, 'a'), (2, null) as t(n, s)")
    assert [r.n for r in writers.in_order(df, "n").collect()] == [1, 2, None]
    assert [r.n for r in writers.in_order(df, "n desc").collect()] == [2, 1, None]
    assert [r.s for r in writers.in_order(df, "coalesce(s, '')").collect()] == [None, "a", "b"]


def test_export_and_load_curated(spark, tables, tmp_path):
    export(tables, str(tmp_path), disabled=["clubs"])
    assert not (tmp_path / "clubs.csv.gz").exists()
    for name in CONTRACTS:
        if name != "clubs":
            loaded = load(spark, str(tmp_path), name)
            assert loaded.columns == CONTRACTS[name].columns
            assert loaded.count() == tables[name].count()
    back = {r.player_id: (r.first_name, r.date_of_birth) for r in load(
        spark, str(tmp_path), "players").collect()}
    want = {r.player_id: (r.first_name, r.date_of_birth) for r in tables["players"].collect()}
    assert back == want
    games = [r.game_id for r in spark.read.option("header", True).csv(
        str(tmp_path / "games.csv.gz")).collect()]
    assert games == sorted(games, key=int)


def test_publish(spark, tables, tmp_path):
    paths = publish_curated(tables, str(tmp_path / "out"), "abc123")
    assert set(paths) == set(CONTRACTS) | {"version"}
    assert spark.read.parquet(paths["version"]).first().commit_hash == "abc123"
    assert spark.read.parquet(paths["games"]).count() == tables["games"].count()
    # The next set takes the place of the first at once; the first stays readable.
    again = publish_curated({"games": tables["games"].limit(1)}, str(tmp_path / "out"), "def456")
    found = Releases(spark, str(tmp_path / "out")).tables()
    assert set(found) == set(paths) and found["games"].count() == 1
    assert found["version"].first().commit_hash == "def456"
    assert spark.read.parquet(paths["version"]).first().commit_hash == "abc123"
    assert again["games"] != paths["games"]


def test_save_table(spark, tables):
    saved = writers.save_table(tables["countries"], "pitchlake_countries")
    assert saved.count() == 1
    spark.sql("drop table pitchlake_countries")
