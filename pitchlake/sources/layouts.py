"""Fields read from each raw source. All leaves are text: parsing is left to the table builders.

Lists keep their elements as JSON text, so that rows can be compared before projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.operators.watch import Watch

APPEARANCES = """
    href string, game_id string, result struct<href: string>, competition_code string,
    `for` struct<href: string>, goals string, assists string, minutes_played string,
    yellow_cards string, second_yellow_cards string, red_cards string"""

GAMES = """
    href string, parent struct<href: string>, matchday string, date string,
    home_club struct<href: string>, away_club struct<href: string>, result string,
    home_club_position string, away_club_position string,
    home_manager struct<name: string>, away_manager struct<name: string>,
    stadium string, attendance string, referee string,
    events array<struct<
        minute: string, type: string, club: struct<href: string, name: string>,
        player: struct<href: string>,
        action: struct<description: string, player_in: struct<href: string>,
                       player_assist: struct<href: string>>>>"""

LINEUP_SIDE = """struct<
    href: string, formation: string, starting_lineup: array<string>, substitutes: array<string>>"""
GAME_LINEUPS = f"game_id string, home_club {LINEUP_SIDE}, away_club {LINEUP_SIDE}"
LINEUP_PLAYER = "number string, href string, name string, team_captain string, position string"

PLAYERS = """
    href string, parent struct<type: string, href: string>, current_club struct<href: string>,
    name string, last_name string, code string,
    place_of_birth struct<country: string, city: string>, citizenship string,
    date_of_birth string, position string, foot string, height string,
    contract_expires string, player_agent struct<name: string>, image_url string,
    international_caps string, international_goals string"""

CLUBS = """
    href string, code string, name string, parent struct<href: string>,
    total_market_value string, squad_size string, average_age string,
    foreigners_number string, foreigners_percentage string, national_team_players string,
    stadium_name string, stadium_seats string, net_transfer_record string, coach_name string"""

NATIONAL_TEAMS = """
    href string, name string, parent struct<country_name: string, country_id: string>,
    code string, confederation string, team_image_url string, squad_size string,
    average_age string, foreigners_number string, foreigners_percentage string,
    total_market_value string, coach_name string, fifa_ranking string"""

COMPETITIONS = """
    href string, parent struct<href: string>, competition_type string, country_id string,
    country_name string, country_code string, total_clubs string"""

COUNTRIES = """
    href string, parent struct<href: string>, country_id string, country_name string,
    country_code string, total_clubs string, total_players string, average_age string"""

MARKET_VALUES = """
    player_id string,
    response struct<list: array<struct<datum_mw: string, mw: string, verein: string>>>"""

TRANSFERS = """
    player_id string,
    response struct<transfers: array<struct<
        dateUnformatted: string, season: string,
        `from`: struct<href: string, clubName: string>,
        `to`: struct<href: string, clubName: string>,
        fee: string, marketValue: string>>>"""


# What checks on responses need to know of them.
ANY_RESPONSE = "player_id string, response struct<list: string>"
TRANSFER_DATES = """
    player_id string, response struct<transfers: array<struct<dateUnformatted: string>>>"""

LAYOUTS = {
    "raw.appearances": APPEARANCES, "raw.games": GAMES, "raw.game_lineups": GAME_LINEUPS,
    "raw.players": PLAYERS, "raw.clubs": CLUBS, "raw.national_teams": NATIONAL_TEAMS,
    "raw.market_values": MARKET_VALUES, "raw.transfers": TRANSFERS,
    "raw.competitions": COMPETITIONS, "raw.countries": COUNTRIES,
}

# Holds the whole line where a part of it does not fit the layout.
CORRUPT = "__corrupt"


def _parsed(raw: DataFrame, layout: str) -> DataFrame:
    """Fields of every line and, for a line that does not fit, the line itself.

    ``inline`` keeps filters on fields from being moved below the parse, where each of them
    would parse the line again. The hash is a stable stand-in for the line in tie-breaks,
    far narrower than the line itself.
    """
    others = [c for c in raw.columns if c != "value"]
    record = F.from_json("value", f"{layout}, {CORRUPT} string",
                         {"columnNameOfCorruptRecord": CORRUPT})
    return raw.select(*others, F.xxhash64("value").alias("line_hash"), F.inline(F.array(record)))


def _unreadable(rows: DataFrame, raw: DataFrame) -> Column:
    """Whether nothing could be read from a line.

    A line is not lost because one field has another shape than the layout: that field is NULL.
    """
    fields = [c for c in rows.columns if c not in {*raw.columns, "line_hash", CORRUPT}]
    nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in fields])
    return F.col(CORRUPT).isNotNull() & nothing


def parse(raw: DataFrame, layout: str, watch: Watch | None = None, source: str = "") -> DataFrame:
    """Replace the line by its fields, parsing every line exactly once.

    Lines that are no JSON objects are left out; a ``watch`` counts them in passing, and lines
    of which a field has another shape.
    """
    rows = _parsed(raw, layout)
    lost = _unreadable(rows, raw)
    if watch:
        rows = watch.over(rows, "unreadable_line", source, {
            "*": F.count_if(lost), "part": F.count_if(F.col(CORRUPT).isNotNull() & ~lost)})
    return rows.filter(~lost).drop(CORRUPT)


def quarantine(raw: DataFrame, layout: str, source: str) -> DataFrame:
    """The lines of a source that ``parse`` leaves out, with their origin."""
    rows = _parsed(raw, layout)
    return rows.filter(_unreadable(rows, raw)).select(
        F.lit(source).alias("source"), "season", "filename", F.col(CORRUPT).alias("value"))
