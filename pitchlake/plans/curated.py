"""Curated tables: joins of base tables, ready for export.

Lookup tables are never marked for broadcast: their size is for the optimiser to check,
and a lookup beyond the limit becomes a sort-merge join whose hot keys are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake.functions.keys import surrogate_key
from pitchlake.functions.text import flag
from pitchlake.operators.asof import asof_join
from pitchlake.operators.reshape import two_sided
from pitchlake.operators.snapshot import current_and_peak
from pitchlake.plans.base import NO_ID


def competitions(base_competitions: DataFrame) -> DataFrame:
    return base_competitions


def countries(base_countries: DataFrame) -> DataFrame:
    return base_countries


def clubs(base_clubs: DataFrame) -> DataFrame:
    return base_clubs


def national_teams(base_national_teams: DataFrame, base_countries: DataFrame) -> DataFrame:
    names = base_countries.select("country_id", "country_name", "country_code")
    return base_national_teams.join(names, "country_id", "left").select(
        "national_team_id", "name", "team_code", "country_id", "country_name", "country_code",
        "confederation", "team_image_url", "squad_size", "average_age", "foreigners_number",
        "foreigners_percentage", "total_market_value", "coach_name", "fifa_ranking",
        "last_season", "url")


def players(base_players: DataFrame, base_clubs: DataFrame,
            base_market_values: DataFrame) -> DataFrame:
    club = base_clubs.select(
        F.col("club_id").alias("current_club_id"),
        F.col("domestic_competition_id").alias("current_club_domestic_competition_id"),
        F.col("name").alias("current_club_name"))
    worth = current_and_peak(base_market_values, "player_id", ["date"], "market_value_in_eur",
                             "market_value_in_eur", "highest_market_value_in_eur")
    joined = base_players.join(worth, "player_id", "left").join(club, "current_club_id", "left")
    return joined.select(
        *base_players.columns, "current_club_domestic_competition_id", "current_club_name",
        "market_value_in_eur", "highest_market_value_in_eur")


def club_names(base_clubs: DataFrame, base_game_events: DataFrame) -> DataFrame:
    """One name per club: that of the club table, else the smallest seen in events."""
    known = base_clubs.select("club_id", "name", F.lit(None).cast("string").alias("seen"))
    # Names are compared among distinct pairs, which each task reduces its events to by hash.
    seen = base_game_events.select(
        "club_id", F.lit(None).cast("string").alias("name"), F.col("club_name").alias("seen")).distinct()
    return (known.unionByName(seen).filter(F.col("club_id").isNotNull())
            .groupBy("club_id").agg(F.coalesce(F.max("name"), F.min("seen")).alias("club_name")))


def games(base_games: DataFrame, base_competitions: DataFrame, base_clubs: DataFrame,
          base_game_events: DataFrame) -> DataFrame:
    kinds = base_competitions.select("competition_id", F.col("type").alias("competition_type"))
    names = club_names(base_clubs, base_game_events)
    home = names.select(F.col("club_id").alias("home_club_id"),
                        F.col("club_name").alias("home_club_name"))
    away = names.select(F.col("club_id").alias("away_club_id"),
                        F.col("club_name").alias("away_club_name"))
    score = F.concat(F.col("home_club_goals").cast("string"), F.lit(":"),
                     F.col("away_club_goals").cast("string"))
    joined = (base_games.join(kinds, "competition_id", "left")
              .join(home, "home_club_id", "left").join(away, "away_club_id", "left"))
    return joined.select(*base_games.columns, "home_club_name", "away_club_name",
                         score.alias("aggregate"), "competition_type")


def club_games(base_games: DataFrame) -> DataFrame:
    sides = two_sided(
        base_games, ["game_id"],
        {"id": ("home_club_id", "away_club_id"),
         "goals": ("home_club_goals", "away_club_goals"),
         "position": ("home_club_position", "away_club_position"),
         "manager": ("home_club_manager_name", "away_club_manager_name")},
        {"id": ("club_id", "opponent_id"),
         "goals": ("own_goals", "opponent_goals"),
         "position": ("own_position", "opponent_position"),
         "manager": ("own_manager_name", "opponent_manager_name")},
        "hosting", ("Home", "Away"))
    won = F.coalesce(flag(F.col("own_goals") > F.col("opponent_goals")), F.lit(0))
    return sides.withColumn("is_win", won)


def appearances(base_appearances: DataFrame, base_games: DataFrame,
                base_players: DataFrame) -> DataFrame:
    days = base_games.select("game_id", "date")
    people = base_players.select(
        "player_id", F.col("name").alias("player_name"),
        F.col("current_club_id").alias("player_current_club_id"))
    joined = base_appearances.join(days, "game_id", "left").join(people, "player_id", "left")
    return joined.select(
        "appearance_id", "game_id", "player_id", "player_club_id",
        F.coalesce("player_current_club_id", F.lit(NO_ID)).alias("player_current_club_id"),
        "date", "player_name", "competition_id", "yellow_cards", "red_cards", "goals",
        "assists", "minutes_played")


def game_events(base_game_events: DataFrame, base_games: DataFrame) -> DataFrame:
    key = surrogate_key("game_id", "player_id", "club_id", "type", "minute", "description",
                        "player_in_id", "player_assist_id")
    return base_game_events.join(base_games.select("game_id", "date"), "game_id", "left").select(
        key.alias("game_event_id"), "date", *base_game_events.columns)


def game_lineups(base_game_lineups: DataFrame, base_games: DataFrame) -> DataFrame:
    key = surrogate_key("game_id", "player_id", "type", "position", "number", "team_captain")
    return base_game_lineups.join(base_games.select("game_id", "date"), "game_id").select(
        key.alias("game_lineups_id"), "date", "game_id", "player_id", "club_id", "player_name",
        "type", "position", "number", "team_captain")


def player_valuations(base_market_values: DataFrame, base_players: DataFrame,
                      base_clubs: DataFrame, base_transfers: DataFrame) -> DataFrame:
    """Valuations with the club the player had joined last by that day."""
    values = base_market_values.select(
        "player_id", "date", "market_value_in_eur", "current_club_name")
    resolved = asof_join(values, base_transfers, "player_id", "date", "transfer_date",
                         ["to_club_id"], [F.col("from_club_id"), F.col("to_club_id")])
    fallback = base_players.select("player_id", F.col("current_club_id").alias("profile_club_id"))
    leagues = base_clubs.select(
        F.col("club_id").alias("current_club_id"),
        F.col("domestic_competition_id").alias("player_club_domestic_competition_id"))
    club = F.coalesce("to_club_id", "profile_club_id")
    return (resolved.join(fallback, "player_id", "left").withColumn("current_club_id", club)
            .join(leagues, "current_club_id", "left")
            .select("player_id", "date", "market_value_in_eur", "current_club_name",
                    "current_club_id", "player_club_domestic_competition_id"))


def transfers(base_transfers: DataFrame, base_players: DataFrame) -> DataFrame:
    names = base_players.select("player_id", F.col("name").alias("player_name"))
    return base_transfers.join(names, "player_id").select(
        "player_id", "transfer_date", "transfer_season", "from_club_id", "to_club_id",
        "from_club_name", "to_club_name", "transfer_fee", "market_value_in_eur", "player_name")
