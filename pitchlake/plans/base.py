"""Base tables: typed, one row per entity, newest usable snapshot.

Most builders take raw rows ``(value, season, filename)``. The only shuffle of a builder
is the one that picks a snapshot per entity; lists are expanded behind it, within the row.
Sources that feed two tables, games and line-ups, have a step of their own, so that they
are parsed and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.functions import dates, match, money
from pitchlake.functions.text import (
    empty_to_zero, filled_float, filled_int, flag, href_id, percentage, squeeze, thousands,
    to_float, to_int, token, trimmed_or_null)
from pitchlake.operators.reshape import explode_distinct, explode_list
from pitchlake.operators.snapshot import latest, newest_snapshot, newest_usable
from pitchlake.operators.watch import Cells
from pitchlake.plans.settings import Settings
from pitchlake.sources import layouts
from pitchlake.sources.layouts import parse

# Raw texts left out or renamed, and ids standing for "none".
BROKEN_VALUATION_DATE = "May 15, 5023"
NO_TRANSFER_DATE = ("0000-00-00", "")
SOUTH_AMERICA = ("South American Football Confederation", "CONMEBOL")
TOURNAMENT_LINK = "/saison_id/"
NO_ID = -1


def _url(settings: Settings) -> Column:
    return F.concat(F.lit(settings.site_root), F.col("href")).alias("url")


def _links(*names: str) -> Column:
    return F.col(".".join(names))


def competitions(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_competitions", settings.watch)
    rows = parse(raw, layouts.COMPETITIONS, settings.watch, "raw.competitions").withColumn(
        "competition_id", token(F.col("href"), 5))
    code = token(F.col("href"), 2)
    kind = F.col("competition_type")
    newest = latest(rows, ["competition_id"], F.desc("filename"), F.desc("line_hash"))
    return cell.select(
        newest, "competition_id",
        code.alias("competition_code"),
        code.alias("name"),
        kind.alias("sub_type"),
        match.bucket(kind, match.COMPETITION_GROUPS, match.OTHER_COMPETITION).alias("type"),
        cell("country_id", F.col("country_id"), to_int, NO_ID),
        "country_name",
        F.col("country_code").alias("domestic_league_code"),
        token(_links("parent", "href"), 3).alias("confederation"),
        cell("total_clubs", F.col("total_clubs"), to_int),
        _url(settings))


def countries(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_countries", settings.watch)
    rows = parse(raw, layouts.COUNTRIES, settings.watch, "raw.countries")
    newest = latest(rows.withColumn("id", to_int(F.col("country_id"))), ["id"],
                    F.desc("filename"), F.desc("line_hash"))
    return cell.select(
        newest, cell("country_id", F.col("country_id"), to_int), "country_name", "country_code",
        token(_links("parent", "href"), 3).alias("confederation"),
        cell("total_clubs", F.col("total_clubs"), filled_int),
        cell("total_players", F.col("total_players"), filled_int),
        cell("average_age", F.col("average_age"), filled_float),
        _url(settings))


def national_teams(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_national_teams", settings.watch)
    rows = parse(raw, layouts.NATIONAL_TEAMS, settings.watch, "raw.national_teams").withColumn(
        "national_team_id", href_id(F.col("href")))
    long_name, short_name = SOUTH_AMERICA
    confederation = F.col("confederation")
    return cell.select(
        newest_snapshot(rows, ["national_team_id"]),
        cell("national_team_id", F.col("href"), href_id),
        F.coalesce(F.nullif("name", F.lit("")), _links("parent", "country_name")).alias("name"),
        F.col("code").alias("team_code"),
        cell("country_id", _links("parent", "country_id"), to_int),
        F.when(confederation == long_name, F.lit(short_name)).otherwise(confederation)
            .alias("confederation"),
        "team_image_url",
        cell("squad_size", F.col("squad_size"), filled_int),
        cell("average_age", F.col("average_age"), filled_float),
        cell("foreigners_number", F.col("foreigners_number"), to_int, 0),
        cell("foreigners_percentage", F.col("foreigners_percentage"), percentage),
        cell("total_market_value", F.col("total_market_value"), money.market_value),
        "coach_name",
        cell("fifa_ranking", F.col("fifa_ranking"), filled_int),
        F.col("season").alias("last_season"),
        "filename",
        _url(settings))


def clubs(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_clubs", settings.watch)
    rows = parse(raw, layouts.CLUBS, settings.watch, "raw.clubs").withColumn(
        "club_id", href_id(F.col("href")))
    return cell.select(
        newest_snapshot(rows, ["club_id"]),
        cell("club_id", F.col("href"), href_id),
        F.col("code").alias("club_code"),
        "name",
        token(_links("parent", "href"), 5).alias("domestic_competition_id"),
        cell("total_market_value", F.col("total_market_value"), to_float),
        cell("squad_size", F.col("squad_size"), filled_int),
        cell("average_age", F.col("average_age"), filled_float),
        cell("foreigners_number", F.col("foreigners_number"), to_int, 0),
        cell("foreigners_percentage", F.col("foreigners_percentage"), percentage),
        cell("national_team_players", F.col("national_team_players"), to_int),
        "stadium_name",
        cell("stadium_seats", token(F.col("stadium_seats"), 1, " "), thousands),
        "net_transfer_record",
        "coach_name",
        F.col("season").alias("last_season"),
        "filename",
        _url(settings))


def players(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_players", settings.watch)
    rows = parse(raw, layouts.PLAYERS, settings.watch, "raw.players").withColumn(
        "player_id", href_id(F.col("href")))
    first, last = trimmed_or_null(F.col("name")), trimmed_or_null(F.col("last_name"))
    with_team = F.coalesce(_links("parent", "type") == "national_team", F.lit(False))
    club = F.when(with_team, href_id(_links("current_club", "href"))).otherwise(
        href_id(_links("parent", "href")))
    detail = match.sub_position(F.col("position"))
    foot = F.col("foot")
    return cell.select(
        newest_snapshot(rows, ["player_id"]),
        cell("player_id", F.col("href"), href_id),
        first.alias("first_name"),
        last.alias("last_name"),
        F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "),
                        F.coalesce(last, F.lit("")))).alias("name"),
        F.col("season").alias("last_season"),
        F.coalesce(club, F.lit(NO_ID)).alias("current_club_id"),
        F.col("code").alias("player_code"),
        F.trim(_links("place_of_birth", "country")).alias("country_of_birth"),
        F.trim(_links("place_of_birth", "city")).alias("city_of_birth"),
        F.trim("citizenship").alias("country_of_citizenship"),
        cell("date_of_birth", F.col("date_of_birth"), dates.birth_date),
        detail.alias("sub_position"),
        match.bucket(detail, match.POSITION_GROUPS, match.NO_POSITION).alias("position"),
        F.when(~F.coalesce(foot.isin("N/A", "null"), F.lit(False)), foot).alias("foot"),
        cell("height_in_cm", F.col("height"), match.height_cm),
        cell("contract_expiration_date", F.col("contract_expires"), dates.contract_date),
        _links("player_agent", "name").alias("agent_name"),
        "image_url",
        cell("international_caps", F.col("international_caps"), filled_int),
        cell("international_goals", F.col("international_goals"), filled_int),
        F.when(with_team, href_id(_links("parent", "href"))).alias("current_national_team_id"),
        _url(settings))


def newest_games(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("newest_games", settings.watch)
    """Newest record of every game, from which games and their events are built."""
    parent = _links("parent", "href")
    date = dates.era_date(F.col("date"), F.col("season"), parent.contains(TOURNAMENT_LINK))
    rows = parse(raw, layouts.GAMES, settings.watch, "raw.games")
    rows = cell.select(rows, *[c for c in rows.columns if c != "date"],
                       cell("game_id", F.col("href"), href_id),
                       cell("date", F.col("date"), lambda text: date))
    return newest_snapshot(rows, ["game_id"]).drop("filename", "line_hash")


def newest_lineups(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("newest_lineups", settings.watch)
    """Newest line-up record of every game, from which formations and players are taken."""
    rows = parse(raw, layouts.GAME_LINEUPS, settings.watch, "raw.game_lineups")
    rows = cell.select(rows, *[c for c in rows.columns if c != "game_id"],
                       cell("game_id", F.col("game_id"), to_int))
    return newest_snapshot(rows, ["game_id"]).drop("filename", "line_hash")


def games(records: DataFrame, lineups: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_games", settings.watch)
    formations = lineups.select(
        "game_id",
        _links("home_club", "formation").alias("home_club_formation"),
        _links("away_club", "formation").alias("away_club_formation"))
    # An undated newest record drops the game: the date is tested behind the pick.
    newest = records.filter(F.col("date").isNotNull())
    parent = _links("parent", "href")
    score = F.col("result")
    sheet = cell.select(
        newest, "game_id",
        token(parent, 5).alias("competition_id"),
        "season",
        F.col("matchday").alias("round"),
        "date",
        cell("home_club_id", _links("home_club", "href"), href_id),
        cell("away_club_id", _links("away_club", "href"), href_id),
        cell("home_club_goals", score, lambda text: match.goals(text, 1)),
        cell("away_club_goals", score, lambda text: match.goals(text, 2)),
        cell("home_club_position", F.col("home_club_position"), match.table_position),
        cell("away_club_position", F.col("away_club_position"), match.table_position),
        _links("home_manager", "name").alias("home_club_manager_name"),
        _links("away_manager", "name").alias("away_club_manager_name"),
        "stadium",
        cell("attendance", F.col("attendance"), match.attendance),
        "referee",
        _url(settings))
    return sheet.join(formations, "game_id", "left")


def game_events(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    def typed(event: Column) -> Column:
        action = event["action"]
        return F.struct(
            to_int(event["minute"]).alias("minute"),
            event["type"].alias("type"),
            href_id(event["club"]["href"]).alias("club_id"),
            event["club"]["name"].alias("club_name"),
            href_id(event["player"]["href"]).alias("player_id"),
            action["description"].alias("description"),
            href_id(action["player_in"]["href"]).alias("player_in_id"),
            href_id(action["player_assist"]["href"]).alias("player_assist_id"))

    # All events of a game sit in one row, so equal ones are dropped there.
    events = explode_distinct(records, F.transform("events", typed), "event")
    return events.select("game_id", "event.*")


def game_lineups(records: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_game_lineups", settings.watch)
    home, away = (href_id(_links(side, "href")) for side in ("home_club", "away_club"))

    def listed(side: str, part: str) -> Column:
        return F.coalesce(_links(side, part), F.array().cast("array<string>"))

    def leg(club: Column, part: str, players: Column) -> Column:
        return F.struct(club.alias("club_id"), F.lit(part).alias("type"), players.alias("players"))

    # Equal entries can only come from the same list of a game, which is one row here, or from
    # the lists of both sides where these name the same club.
    legs = []
    for part in ("starting_lineup", "substitutes"):
        own, others = listed("home_club", part), listed("away_club", part)
        legs += [leg(home, part, F.array_distinct(own)),
                 leg(away, part, F.when(home.eqNullSafe(away), F.array_except(others, own))
                     .otherwise(F.array_distinct(others)))]
    teams = explode_list(records.select("game_id", "home_club", "away_club"), F.array(*legs), "leg")
    entries = explode_list(teams.select("game_id", "leg.*"), F.col("players"), "player")
    read = entries.select("game_id", "club_id", "type",
                          F.from_json("player", layouts.LINEUP_PLAYER).alias("p"))
    return cell.select(
        read, "game_id", "club_id", "type",
        squeeze(F.col("p.number")).alias("number"),
        cell("player_id", F.col("p.href"), href_id),
        F.col("p.name").alias("player_name"),
        cell("team_captain", F.col("p.team_captain"), to_int),
        F.col("p.position").alias("position"))


def appearances(raw: DataFrame, base_games: DataFrame,
                settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_appearances", settings.watch)
    codes = settings.competition_codes
    rows = parse(raw, layouts.APPEARANCES, settings.watch, "raw.appearances").filter(
        F.col("competition_code").isin(*codes))
    yellow = flag(F.length("yellow_cards") > 0) + flag(F.length("second_yellow_cards") > 0)
    typed = cell.select(
        rows, cell("player_id", F.col("href"), href_id),
        F.coalesce(F.col("game_id").try_cast("int"),
                   token(_links("result", "href"), 5).try_cast("int"),
                   F.lit(NO_ID)).alias("game_id"),
        F.col("competition_code").alias("competition_id"),
        F.regexp_extract(_links("for", "href"), r"/verein/(\d+)", 1).try_cast("int")
            .alias("player_club_id"),
        cell("goals", F.col("goals"), empty_to_zero),
        cell("assists", F.col("assists"), empty_to_zero),
        cell("minutes_played", F.replace("minutes_played", F.lit("'"), F.lit("")), empty_to_zero),
        yellow.alias("yellow_cards"),
        F.when(F.length("red_cards") > 0, 1).otherwise(0).alias("red_cards"),
        "season", "filename", "line_hash")
    # The placeholder may sit on very many rows and has no game: it goes before any shuffle.
    # Distinct ids tell Spark that it need not look up what else a planned game holds.
    ids = base_games.select("game_id").distinct()
    known = typed.filter(F.col("game_id") != NO_ID).join(ids, "game_id", "left_semi")
    once = newest_snapshot(known, ["game_id", "player_id"])
    key = F.concat(F.col("game_id").cast("string"), F.lit("_"), F.col("player_id").cast("string"))
    return once.select(
        "player_id", "game_id", key.alias("appearance_id"), "competition_id", "player_club_id",
        "goals", "assists", "minutes_played", "yellow_cards", "red_cards")


def market_values(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_market_values", settings.watch)
    rows = parse(raw, layouts.MARKET_VALUES, settings.watch, "raw.market_values").withColumn(
        "player_id", to_int(F.col("player_id")))
    newest = newest_usable(rows, ["player_id"], F.col("response").isNotNull())
    points = explode_list(newest, _links("response", "list"), "point", "position").select(
        "player_id", "season", "filename", "position",
        F.col("point.datum_mw").alias("datetime_str"),
        F.col("point.mw").alias("mw"),
        F.col("point.verein").alias("current_club_name"))
    day_of = Cells("base_market_values", settings.watch)
    day = dates.first_format(F.col("datetime_str"), dates.MONTH_NAME, dates.DAY_FIRST)
    dated = day_of.select(points.filter(F.col("datetime_str") != "-"), "*",
                          day_of("day", F.col("datetime_str"), lambda text: day))
    valued = F.coalesce(F.col("mw") != "-", F.lit(False))
    daily = latest(dated, ["player_id", "day"], valued.desc(), F.asc("position"))
    kept = daily.filter(F.col("day").isNotNull() & (F.col("mw") != "-")
                        & (F.col("datetime_str") != BROKEN_VALUATION_DATE))
    return cell.select(
        kept, "player_id",
        cell("market_value_in_eur", F.col("mw"), money.market_value),
        "datetime_str",
        dates.clamp(F.col("day"), dates.run_date(settings.as_of)).alias("date"),
        "current_club_name",
        F.col("season").alias("last_season"),
        "filename")


def transfers(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cell = Cells("base_transfers", settings.watch)
    rows = parse(raw, layouts.TRANSFERS, settings.watch, "raw.transfers").withColumn(
        "player_id", to_int(F.col("player_id")))
    newest = newest_usable(rows, ["player_id"], F.col("response").isNotNull())
    moves = explode_list(newest, _links("response", "transfers"), "move", "position").select(
        "player_id", "filename", "position",
        F.col("move.dateUnformatted").alias("date_text"),
        F.col("move.season").alias("transfer_season"),
        href_id(F.col("move.from.href")).alias("from_club_id"),
        href_id(F.col("move.to.href")).alias("to_club_id"),
        F.col("move.from.clubName").alias("from_club_name"),
        F.col("move.to.clubName").alias("to_club_name"),
        F.col("move.fee").alias("fee"),
        F.col("move.marketValue").alias("market_value"))
    dated = moves.filter(~F.col("date_text").isin(*NO_TRANSFER_DATE))
    once = latest(dated, ["player_id", "date_text", "from_club_id", "to_club_id"],
                  F.desc("filename"), F.asc("position"))
    return cell.select(
        once, "player_id",
        cell("transfer_date", F.col("date_text"), dates.iso_date),
        "transfer_season", "from_club_id", "to_club_id", "from_club_name", "to_club_name",
        cell("transfer_fee", F.col("fee"), money.transfer_fee),
        cell("market_value_in_eur", F.col("market_value"), money.transfer_amount),
        F.col("filename").alias("source_filename"))
