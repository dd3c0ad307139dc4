"""Data checks of the warehouse: one report over all tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from pitchlake.functions.text import to_int
from pitchlake.operators import quality as q
from pitchlake.plans.contracts import CONTRACTS
from pitchlake.session import scratch
from pitchlake.sources import layouts

# Accepted row counts of a full build.
ROW_COUNTS = {
    "appearances": (1_400_000, 2_000_000),
    "clubs": (650, 850),
    "competitions": (55, 75),
    "players": (35_000, 80_000),
    "player_valuations": (430_000, 850_000),
    "games": (80_000, 110_000),
    "club_games": (160_000, 230_000),
    "game_events": (950_000, 1_500_000),
    "game_lineups": (81_000, 3_500_000),
    "countries": (100, 250),
    "national_teams": (100, 250),
}

# Keys that must be unique and columns that must be filled.
UNIQUE = {
    "base_appearances": [["appearance_id"]],
    "base_games": [["game_id"]],
    "base_players": [["player_id"]],
    "base_countries": [["country_id"]],
    "base_national_teams": [["national_team_id"]],
    "base_market_values": [["player_id", "date"]],
    "base_transfers": [["player_id", "transfer_date", "from_club_id", "to_club_id"]],
    "appearances": [["appearance_id"]],
    "clubs": [["club_code"]],
    "competitions": [["competition_id"]],
    "players": [["player_id"]],
    "player_valuations": [["player_id", "date"]],
    "games": [["game_id"]],
    "club_games": [["game_id", "club_id"]],
    "game_events": [["game_event_id"]],
    "game_lineups": [["game_lineups_id"]],
    "countries": [["country_id"]],
    "national_teams": [["national_team_id"]],
}
FILLED = {
    "base_games": ["date"],
    "base_countries": ["country_id"],
    "base_national_teams": ["national_team_id"],
    "appearances": ["game_id", "date"],
    "clubs": ["club_code", "name"],
    "competitions": ["name"],
    "players": ["player_id", "player_code", "name"],
    "player_valuations": ["player_id", "market_value_in_eur"],
    "games": ["game_id", "date"],
    "game_events": ["game_event_id", "minute"],
    "game_lineups": ["game_id", "date", "game_lineups_id"],
    "countries": ["country_id", "country_name"],
    "national_teams": ["national_team_id", "name"],
    "transfers": ["player_id", "transfer_date", "from_club_id", "to_club_id", "player_name",
                  "from_club_name", "to_club_name"],
}

# Tolerated shares of missing values.
TOLERANCES = {
    "players": {"current_club_name": 0.15, "market_value_in_eur": 0.40,
                "contract_expiration_date": 0.40, "date_of_birth": 0.01},
    "games": {"home_club_name": 0.005, "away_club_name": 0.005,
              "home_club_manager_name": 0.012, "away_club_manager_name": 0.012},
    "national_teams": {"confederation": 0.02},
}

# Accepted positions and confederations.
POSITIONS = ("Attack", "Defender", "Midfield", "Goalkeeper", "Missing")
CONFEDERATIONS = ("UEFA", "CONMEBOL", "CONCACAF", "CAF", "AFC", "OFC")

# League checks. Leagues that do not play a double round robin, single
# seasons that were cut short or changed, the accepted number of first-tier leagues,
# the fewest games of a matchday and the season in which it is not asked for.
FIRST_TIER = "first_tier"
OTHER_FORMATS = ("SC1", "DK1", "A1", "C1", "KR1", "RSK1", "ARG1", "MLS1", "MEX1", "COL1", "AUS1")
SHORT_SEASONS = (("FR1", 2019), ("NL1", 2019), ("BE1", 2019), ("UKR1", 2021), ("UKR1", 2013),
                 ("UKR1", 2014), ("UKR1", 2016), ("GR1", 2014))
LEAGUES = (31, 32)
MATCHDAY_GAMES = 9
RUNNING_SEASON = 2025

# Appearances per month, with the months and years of pause.
MONTHLY_APPEARANCES = 9500
PAUSE_MONTHS = (5, 6, 7, 12, 1)
PAUSE_YEARS = (2020, 2026)

# First valuation and transfer dates, years of line-ups, the highest share
# of missing responses per season in percent, and a player known to have changed clubs.
FIRST_VALUATION = "2000-01-20"
FIRST_TRANSFER = "1970-01-01"
TRANSFER_HORIZON_MONTHS = 60
LINEUP_YEARS = ("2013-01-01", "2026-01-01")
NULL_RESPONSE_PCT = 10
KNOWN_MOVER = 8246


def row_rules(table: str, as_of) -> list[q.Rule]:
    """All rules of one table that a single aggregation can measure."""
    rules = [q.not_null(c) for c in FILLED.get(table, [])]
    rules += [q.missing_share(c, t) for c, t in TOLERANCES.get(table, {}).items()]
    if table in ROW_COUNTS:
        rules.append(q.row_count_between(*ROW_COUNTS[table]))
    if table == "clubs":
        rules.append(q.values_not_in("name", ["null"]))
    if table == "players":
        rules.append(q.accepted_values("position", POSITIONS))
    if table == "national_teams":
        rules.append(q.accepted_values("confederation", CONFEDERATIONS))
    if table == "player_valuations":
        rules.append(q.values_between("date", F.lit(FIRST_VALUATION).cast("date"), as_of))
    if table == "transfers":
        rules.append(q.values_between("transfer_date", F.lit(FIRST_TRANSFER).cast("date"),
                                      F.add_months(as_of, TRANSFER_HORIZON_MONTHS)))
        rules += [q.values_between(c, 0) for c in ("transfer_fee", "market_value_in_eur")]
    return rules


def league_checks(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    leagues = t["competitions"].filter(F.col("sub_type") == FIRST_TIER)
    by_matchday = t["games"].join(leagues.select("competition_id"), "competition_id", "left_semi")
    count = leagues.agg(F.count("*").alias("leagues"))
    return [
        q.verdict(q.small_groups(by_matchday, ["round", "season", "competition_id"],
                                 F.col("season") != RUNNING_SEASON, MATCHDAY_GAMES),
                  "games_per_matchday", "games", "round"),
        q.verdict(q.incomplete_parents(leagues, "competition_id", "total_clubs", t["clubs"],
                                       "domestic_competition_id", "club_id"),
                  "clubs_per_league", "clubs", "domestic_competition_id"),
        q.verdict(q.incomplete_round_robin(t["games"], "competition_id", "season", "game_id",
                                           "home_club_id", leagues, OTHER_FORMATS,
                                           SHORT_SEASONS),
                  "double_round_robin", "games", "season"),
        q.verdict(count.filter(~F.col("leagues").between(*LEAGUES)),
                  "number_of_leagues", "competitions", "sub_type"),
    ]


def history_checks(t: Mapping[str, DataFrame], raw: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Checks against the raw responses."""
    values = layouts.parse(raw["raw.market_values"], layouts.ANY_RESPONSE)
    shares = q.null_shares(values, "season", F.col("response").isNull())
    moves = layouts.parse(raw["raw.transfers"], layouts.TRANSFER_DATES).withColumn(
        "player_id", to_int(F.col("player_id")))
    # One usable move is enough, so moves are not expanded.
    usable = F.exists("response.transfers",
                      lambda move: ~move["dateUnformatted"].isin("", "0000-00-00"))
    return [
        q.verdict(shares.filter(F.col("null_pct") > NULL_RESPONSE_PCT),
                  "null_responses", "raw.market_values", "response", "warn"),
        q.verdict(q.lost_entities(moves, usable, t["base_transfers"], "player_id"),
                  "lost_history", "base_transfers", "player_id"),
    ]


def warehouse_report(t: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
                     as_of=None, unreadable: DataFrame | None = None) -> DataFrame:
    """One row per check over base and curated tables.

    ``unreadable`` adds the counts of lines and cells that the build could not read. Row rules
    of a table take one scan and all its keys another, whose counts are stored and serve
    uniqueness and relationships.
    """
    as_of = F.current_date() if as_of is None else as_of
    spark = next(iter(t.values())).sparkSession
    index = q.key_index(t, UNIQUE, CONTRACTS.values(), scratch(spark, "keys"))
    parts = []
    for table, df in t.items():
        rules = row_rules(table, as_of)
        if rules:
            parts.append(q.measure(df, table, rules))
        if table in CONTRACTS:
            parts.append(q.missing_columns(df, table, CONTRACTS[table].columns))
    date = F.col("date")
    regular = ~F.month(date).isin(*PAUSE_MONTHS) & ~F.year(date).isin(*PAUSE_YEARS)
    parts.append(q.verdict(
        q.few_distinct(t["appearances"], "appearance_id", F.trunc(date, "month"),
                       MONTHLY_APPEARANCES, regular),
        "monthly_appearances", "appearances", "appearance_id"))
    parts.append(q.verdict(q.date_gaps(t["game_lineups"], "date", "year", *LINEUP_YEARS),
                           "yearly_lineups", "game_lineups", "date"))
    parts.append(q.verdict(
        q.outside_pair(t["appearances"], "player_club_id", t["games"], "game_id",
                       ("home_club_id", "away_club_id")),
        "club_plays_game", "appearances", "player_club_id"))
    parts.append(q.verdict(
        q.short_history_of(t["player_valuations"], "player_id", KNOWN_MOVER,
                           "current_club_id", 2),
        "club_transitions", "player_valuations", "current_club_id"))
    parts += league_checks(t)
    parts += history_checks(t, raw)
    parts += [q.index_unique(index, UNIQUE, t), q.index_foreign_keys(index, t, CONTRACTS.values())]
    if unreadable is not None:
        parts.append(unreadable)
    return q.report(parts)
