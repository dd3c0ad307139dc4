"""Golden results of all tables on the hand-written snapshots."""

from datetime import date
from decimal import Decimal

import pytest

from pitchlake.plans.contracts import CONTRACTS
from pitchlake.plans.warehouse import TABLES


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.collect()}


def test_all_tables_are_built(tables):
    assert set(tables) == set(TABLES)


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_contract_holds(tables, name):
    assert tables[name].columns == CONTRACTS[name].columns


def test_competitions(tables):
    rows = by(tables["competitions"], "competition_id", "competition_code", "name", "type",
              "country_id", "confederation", "total_clubs", "url")
    assert rows["L1"] == ("bundesliga", "bundesliga", "domestic_league", 40, "europa", 18,
                          "https://example.org/bundesliga/startseite/wettbewerb/L1")
    assert rows["FIWC"][2:5] == ("national_team_competition", -1, "fifa")
    assert rows["EL"][2] == "other"
    assert rows["ELX"][2] == "international_cup"


def test_countries(tables):
    assert by(tables["countries"], "country_id", "country_name", "confederation", "total_clubs",
              "total_players", "average_age") == {33: ("Chile", "amerika", 16, None, 27.5)}


def test_national_teams(tables):
    row = tables["national_teams"].first()
    assert (row.national_team_id, row.name, row.country_name, row.confederation) == (
        99, "Chile", "Chile", "CONMEBOL")
    assert (row.squad_size, row.average_age, row.foreigners_number,
            row.foreigners_percentage) == (23, None, 0, None)
    # Single precision carries through, as in the published tables.
    assert row.total_market_value == 105349998
    assert row.last_season == 2024


def test_clubs(tables):
    rows = by(tables["clubs"], "club_id", "name", "squad_size", "foreigners_number",
              "foreigners_percentage", "stadium_seats", "last_season", "total_market_value")
    assert rows[10] == ("Ten", None, 7, None, None, 2024, None)
    assert rows[20][:3] == ("Twenty", 25, 0)
    assert rows[20][3] == pytest.approx(55.6, abs=1e-4)
    assert rows[20][4:] == (81044, 2023, 1500000.0)


def test_players(tables):
    rows = by(tables["players"], "player_id", "first_name", "last_name", "name",
              "current_club_id", "date_of_birth", "sub_position", "position", "foot",
              "height_in_cm", "contract_expiration_date", "current_national_team_id")
    assert rows[1] == ("New", "Star", "New Star", 10, date(2000, 1, 1), "Left Winger", "Attack",
                       "right", 185, date(2026, 6, 30), None)
    assert rows[2] == ("A", "B", "A B", 20, date(1999, 1, 1), "Goalkeeper", "Goalkeeper", None,
                       None, date(2027, 6, 30), 99)
    assert rows[3][:4] == (None, "Solo", "Solo", 10)
    assert rows[4][3:] == (-1, None, None, "Missing", None, None, date(2026, 6, 1), 99)
    assert rows[5][4:7] == (date(2002, 8, 5), "Sweeper", "Missing")
    worth = by(tables["players"], "player_id", "market_value_in_eur",
               "highest_market_value_in_eur", "current_club_name",
               "current_club_domestic_competition_id")
    assert worth[1] == (105349998, 105349998, "Ten", "L1")
    assert worth[2] == (500000, 500000, "Twenty", "L1")
    assert worth[5][:2] == (None, None)
    caps = by(tables["players"], "player_id", "international_caps", "international_goals",
              "country_of_birth", "agent_name")
    assert caps[1] == (12, None, "Chile", "Agency")


def test_games(tables):
    rows = by(tables["games"], "game_id", "date", "home_club_goals", "away_club_goals",
              "aggregate", "home_club_position", "away_club_position", "competition_type")
    assert rows == {
        100: (date(2023, 5, 8), 2, 1, "2:1", 5, -1, "domestic_league"),
        101: (date(2023, 8, 13), None, None, None, None, None, "domestic_league"),
        102: (date(2023, 8, 5), 0, 0, "0:0", None, None, "national_team_competition"),
        105: (date(2024, 8, 5), 1, 3, "1:3", None, -1, "domestic_league"),
        106: (date(2024, 8, 25), 3, 3, "3:3", None, None, "domestic_league"),
        107: (date(1969, 2, 1), 1, 0, "1:0", None, None, "domestic_league"),
    }
    names = by(tables["games"], "game_id", "home_club_name", "away_club_name",
               "home_club_formation", "attendance")
    assert names[100] == ("Ten", "Twenty", "3-5-2", 45123)
    assert names[105] == ("Ten", "Seen In Events", None, None)
    assert names[107][0] is None


def test_club_games(tables):
    rows = {(r.game_id, r.hosting): (r.club_id, r.own_goals, r.opponent_id, r.opponent_goals,
                                     r.is_win) for r in tables["club_games"].collect()}
    assert len(rows) == 2 * tables["games"].count()
    assert rows[100, "Home"] == (10, 2, 20, 1, 1)
    assert rows[100, "Away"] == (20, 1, 10, 2, 0)
    assert rows[101, "Home"][-1] == 0
    assert rows[106, "Away"][-1] == 0


def test_game_events(tables):
    rows = tables["game_events"].orderBy("game_id", "minute").collect()
    assert [(r.game_id, r.minute, r.type, r.club_id, r.player_id, r.player_in_id)
            for r in rows] == [(100, 5, "Goals", 10, 1, None),
                               (100, 60, "Substitutions", 30, 3, 4),
                               (105, 1, "Cards", 10, 1, None)]
    assert len({r.game_event_id for r in rows}) == 3
    assert rows[0].date == date(2023, 5, 8)


def test_game_lineups(tables):
    base = sorted(tuple(r) for r in tables["base_game_lineups"].filter("game_id = 100").collect())
    # Two entries differ in a field that is not read: both are kept.
    assert base == [(100, 10, "starting_lineup", "10", 1, "N1", 1, "Goalkeeper")] * 2 + [
        (100, 20, "substitutes", "7", 2, "N2", 0, "Goalkeeper")]
    assert {r.game_id for r in tables["game_lineups"].collect()} == {100}


def test_appearances(tables):
    rows = by(tables["appearances"], "appearance_id", "goals", "assists", "minutes_played",
              "yellow_cards", "red_cards", "player_name", "player_current_club_id", "date")
    assert set(rows) == {"100_1", "101_2", "102_1", "102_2", "105_9"}
    assert rows["100_1"][:5] == (1, 0, 90, 1, 0)
    assert rows["101_2"][:5] == (0, 0, 90, 1, 1)
    assert rows["102_1"][3] == 2
    assert rows["102_2"][:5] == (None, 0, 0, None, 0)
    assert rows["105_9"][5:] == (None, -1, date(2024, 8, 5))


def test_market_values(tables):
    rows = sorted((r.player_id, r.date, r.market_value_in_eur, r.last_season)
                  for r in tables["base_market_values"].collect()
                  if r.market_value_in_eur is not None)
    assert rows == [
        (1, date(2020, 5, 15), 1500000, 2023), (1, date(2021, 7, 1), 2000000, 2023),
        (1, date(2025, 6, 30), 105349998, 2023), (2, date(2022, 1, 5), 500000, 2024),
        (8, date(2022, 1, 5), 1000000, 2024)]


def test_player_valuations(tables):
    rows = {(r.player_id, r.date): (r.current_club_id, r.player_club_domestic_competition_id)
            for r in tables["player_valuations"].collect()}
    assert rows[1, date(2020, 5, 15)] == (10, "L1")
    assert rows[1, date(2021, 7, 1)] == (20, "L1")
    # The last transfer has no destination: it wins, and the profile club stands in.
    assert rows[1, date(2022, 7, 1)] == (10, "L1")
    assert rows[2, date(2022, 1, 5)] == (20, "L1")
    assert rows[8, date(2022, 1, 5)] == (2, None)


def test_transfers(tables):
    base = {(r.player_id, r.transfer_date): (r.to_club_id, r.transfer_fee, r.market_value_in_eur)
            for r in tables["base_transfers"].collect()}
    assert base == {
        (1, date(2021, 7, 1)): (20, Decimal("1500000.000"), Decimal("350000.000")),
        (1, date(2022, 1, 1)): (None, Decimal("0.000"), None),
        (1, date(2020, 1, 1)): (10, Decimal("0.000"), Decimal("125.000")),
        (8, date(2020, 1, 1)): (2, None, None)}
    assert {r.player_id for r in tables["transfers"].collect()} == {1}
    assert {r.player_name for r in tables["transfers"].collect()} == {"New Star"}


def test_report(spark, tables, raw):
    from pyspark.sql import functions as F

    from pitchlake.plans.checks import warehouse_report

    rows = {(r.check, r.table, r.column): r for r in warehouse_report(
        tables, raw, F.lit("2025-06-30").cast("date")).collect()}
    assert rows["unique", "games", "game_id"].failures == 0
    # Equal entries that differ in an unread field collide in the hashed key.
    assert rows["unique", "game_lineups", "game_lineups_id"].failures == 1
    assert rows["row_count", "games", "*"].failures == 1
    assert rows["row_count", "games", "*"].detail == "6"
    assert rows["null_responses", "raw.market_values", "response"].failures == 2
    assert rows["null_responses", "raw.market_values", "response"].severity == "warn"
    assert rows["lost_history", "base_transfers", "player_id"].failures == 0
    assert rows["columns_contain", "players", "*"].failures == 0
    assert rows["accepted_values", "players", "position"].failures == 0
    assert rows["yearly_lineups", "game_lineups", "date"].failures == 12
    assert rows["club_transitions", "player_valuations", "current_club_id"].failures == 1
    assert rows["foreign_key", "appearances", "player_id"].failures == 1
    assert rows["club_plays_game", "appearances", "player_club_id"].failures == 0
    assert rows["number_of_leagues", "competitions", "sub_type"].failures == 1
    assert rows["clubs_per_league", "clubs", "domestic_competition_id"].failures == 1


def small_sources(spark):
    lines = ['{"href":"/c/startseite/verein/10","name":"Ten","squad_size":"7"}',
             '{"href":"/c/startseite/verein/20","name":"Twenty","squad_size":"many"}', '{"href": broken', "[1]"]
    schema = "value string, season int, filename string"
    clubs = spark.createDataFrame([(x, 2024, "raw/2024/clubs.json") for x in lines], schema)
    player = '{"href":"/p/profil/spieler/1","name":"A","height":"tall","parent":{"href":"/c/startseite/verein/10"}}'
    return clubs, spark.createDataFrame([(player, 2024, "raw/2024/players.json")], schema)


def test_a_build_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    from pitchlake.plans import warehouse
    from pitchlake.plans.settings import Settings

    for name, df in zip(("clubs", "players"), small_sources(spark)):
        df.select("value").write.text(str(tmp_path / name / "2024"))

    def sources():
        return {f"raw.{n}": warehouse.read_snapshots(spark, str(tmp_path / n / "*"))
                for n in ("clubs", "players")}

    def count_builds(fail=None):
        built, real = [], warehouse._build

        def build(name, *rest):
            built.append(name)
            if name == fail:
                raise RuntimeError("executor lost")
            return real(name, *rest)

        monkeypatch.setattr(warehouse, "_build", build)
        return built

    root, settings = str(tmp_path / "build"), Settings(as_of="2025-06-30")
    targets = ["base_players", "clubs"]
    count_builds(fail="base_players")
    with pytest.raises(RuntimeError):
        warehouse.run(sources(), root, targets, settings, threads=1)
    assert warehouse.released(spark, root) == {}
    monkeypatch.undo()
    built = count_builds()
    warehouse.run(sources(), root, targets, settings, threads=1)
    assert "base_players" in built and "base_clubs" not in built
    release = warehouse.released(spark, root)
    assert {n: df.count() for n, df in release.items()} == {"base_players": 1, "base_clubs": 2, "clubs": 2}
    # Nothing has changed: nothing is built, no release is made.
    built.clear()
    warehouse.run(sources(), root, targets, settings)
    assert built == [] and warehouse.Run(spark, root).releases.number() == 1
    # New input: what depends on it is built anew, and a failure leaves the release as it is.
    more = small_sources(spark)[0].limit(1).select(F_replace("value"))
    more.write.mode("append").text(str(tmp_path / "clubs" / "2024"))
    monkeypatch.undo()
    count_builds(fail="clubs")
    with pytest.raises(RuntimeError):
        warehouse.run(sources(), root, targets, settings)
    assert warehouse.released(spark, root)["clubs"].count() == 2
    monkeypatch.undo()
    built = count_builds()
    warehouse.run(sources(), root, targets, settings)
    assert built == ["clubs"] and warehouse.released(spark, root)["clubs"].count() == 3
    # Counts and quarantine belong to the build of these sources.
    found = warehouse.unreadable(sources(), root, targets, settings).filter("failures > 0")
    assert sorted((r.check, r.table, r.column, r.failures) for r in found.collect()) == [
        ("unreadable_cell", "base_clubs", "squad_size", 1),
        ("unreadable_cell", "base_players", "height_in_cm", 1),
        ("unreadable_line", "raw.clubs", "*", 2)]
    lost = warehouse.quarantine(sources(), found).collect()
    assert sorted(r.value for r in lost) == ["[1]", '{"href": broken']


def F_replace(column):
    from pyspark.sql import functions as F
    return F.replace(column, F.lit("verein/10"), F.lit("verein/30")).alias(column)


def test_a_build_that_reads_everything_has_no_quarantine(spark, tmp_path):
    from pitchlake.plans import warehouse

    raw = {"raw.clubs": small_sources(spark)[0].limit(1)}
    warehouse.run(raw, str(tmp_path / "b"), ["clubs"])
    counts = spark.createDataFrame([], "check string, table string, column string, failures long")
    assert warehouse.quarantine(raw, counts) is None


def test_responses_of_a_season_are_read_from_its_store(spark, tmp_path):
    from pitchlake.operators.gate import guarded_write
    from pitchlake.plans import warehouse
    from pitchlake.sinks.releases import Releases
    from pyspark.sql import functions as F

    response = spark.createDataFrame([(1, "x"), (2, None)], "player_id int, response string")
    for season, rows in ((2023, response), (2024, response.filter("player_id = 1"))):
        store = Releases(spark, str(tmp_path / "api" / str(season)))
        guarded_write(store, {"market_values.json": rows, "transfers.json": rows}, F.lit(False))
    (tmp_path / "plain").mkdir()
    for name in warehouse.PLAIN_FILES.values():
        (tmp_path / "plain" / name).write_text("{}")
    for name, file in warehouse.SEASON_FILES.items():
        if file.endswith(".gz"):
            response.select(F.lit("{}")).write.text(str(tmp_path / "scraper" / "2024" / file))
    raw = warehouse.read_sources(spark, str(tmp_path / "scraper"), str(tmp_path / "api"),
                                 str(tmp_path / "plain"), seasons=[2024], stored=[2023, 2024])
    assert sorted(r.season for r in raw["raw.market_values"].collect()) == [2023, 2023, 2024]
    assert {r.season for r in raw["raw.games"].collect()} == {2024}
