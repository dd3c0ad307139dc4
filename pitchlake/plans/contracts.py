"""Declared fields, keys and relationships of the curated tables."""

from __future__ import annotations

from pitchlake.operators.contract import Contract, Field, ForeignKey

EXPLORE = "explore"


def _fields(spec: str) -> tuple[Field, ...]:
    """Fields from ``name type`` lines; a star marks a default filter column."""
    fields = []
    for line in filter(None, map(str.strip, spec.splitlines())):
        text, _, description = line.partition("  ")
        name, kind = text.rstrip("*").split()
        tags = (EXPLORE,) if text.endswith("*") else ()
        fields.append(Field(name, kind, description.strip() or None, tags))
    return tuple(fields)


def _key(column: str, table: str, target: str | None = None) -> ForeignKey:
    return ForeignKey((column,), table, (target or column,))


COMPETITIONS = Contract("competitions", _fields("""
    competition_id string
    competition_code string
    name string
    sub_type string
    type string
    country_id integer
    country_name string
    domestic_league_code string
    confederation string*
    total_clubs integer
    url string
"""), ("competition_id",))

CLUBS = Contract("clubs", _fields("""
    club_id integer
    club_code string
    name string
    domestic_competition_id string*
    total_market_value number  Aggregated market value of the squad in EUR.
    squad_size integer
    average_age number
    foreigners_number integer
    foreigners_percentage number
    national_team_players integer
    stadium_name string
    stadium_seats integer
    net_transfer_record string
    coach_name string
    last_season integer
    filename string
    url string
"""), ("club_id",), (_key("domestic_competition_id", "competitions", "competition_id"),))

PLAYERS = Contract("players", _fields("""
    player_id integer
    first_name string
    last_name string
    name string
    last_season integer
    current_club_id integer
    player_code string
    country_of_birth string
    city_of_birth string
    country_of_citizenship string
    date_of_birth date
    sub_position string
    position string
    foot string
    height_in_cm integer
    contract_expiration_date date
    agent_name string
    image_url string
    international_caps integer
    international_goals integer
    current_national_team_id integer
    url string
    current_club_domestic_competition_id string
    current_club_name string*
    market_value_in_eur number  Latest market value in EUR.
    highest_market_value_in_eur number  Highest market value so far in EUR.
"""), ("player_id",), (
    _key("current_club_id", "clubs", "club_id"),
    _key("current_club_domestic_competition_id", "competitions", "competition_id"),
    _key("current_national_team_id", "national_teams", "national_team_id")))

GAMES = Contract("games", _fields("""
    game_id integer
    competition_id string*
    season integer*
    round string*
    date date*
    home_club_id integer
    away_club_id integer
    home_club_goals integer
    away_club_goals integer
    home_club_position integer
    away_club_position integer
    home_club_manager_name string
    away_club_manager_name string
    stadium string
    attendance integer
    referee string
    url string
    home_club_formation string
    away_club_formation string
    home_club_name string*
    away_club_name string*
    aggregate string
    competition_type string
"""), ("game_id",), (
    _key("competition_id", "competitions"),
    _key("home_club_id", "clubs", "club_id"),
    _key("away_club_id", "clubs", "club_id")))

CLUB_GAMES = Contract("club_games", _fields("""
    game_id integer
    club_id integer
    own_goals integer
    own_position integer
    own_manager_name string*
    opponent_id integer
    opponent_goals integer
    opponent_position integer
    opponent_manager_name string
    hosting string
    is_win integer
"""), ("club_id", "game_id"), (_key("club_id", "clubs"), _key("game_id", "games")))

APPEARANCES = Contract("appearances", _fields("""
    appearance_id string
    game_id integer
    player_id integer
    player_club_id integer
    player_current_club_id integer
    date date*
    player_name string*
    competition_id string
    yellow_cards integer
    red_cards integer
    goals integer
    assists integer
    minutes_played integer
"""), ("appearance_id",), (_key("game_id", "games"), _key("player_id", "players")))

GAME_EVENTS = Contract("game_events", _fields("""
    game_event_id string  Hash of the key fields.
    date date
    game_id integer
    minute integer
    type string
    club_id integer
    club_name string
    player_id integer
    description string
    player_in_id integer  Player who enters the game in a substitution.
    player_assist_id integer  Player who assisted a goal.
"""), ("game_id", "player_id", "club_id", "type", "minute", "description", "player_in_id",
       "player_assist_id"), (_key("game_id", "games"),))

GAME_LINEUPS = Contract("game_lineups", _fields("""
    game_lineups_id string  Hash of the key fields.
    date date
    game_id integer
    player_id integer
    club_id integer
    player_name string
    type string
    position string
    number string
    team_captain integer
"""), ("game_id", "player_id", "club_id"), (_key("game_id", "games"),))

PLAYER_VALUATIONS = Contract("player_valuations", _fields("""
    player_id integer
    date date*
    market_value_in_eur number  Market value at that day in EUR.
    current_club_name string
    current_club_id integer
    player_club_domestic_competition_id string
"""), ("player_id", "date"), (_key("player_id", "players"),))

TRANSFERS = Contract("transfers", _fields("""
    player_id integer
    transfer_date date
    transfer_season string
    from_club_id integer
    to_club_id integer
    from_club_name string*
    to_club_name string*
    transfer_fee number  Fee in EUR, 0 for a free transfer, empty if unknown.
    market_value_in_eur number  Market value at the transfer in EUR.
    player_name string
"""), ("player_id", "transfer_date", "from_club_id", "to_club_id"), (_key("player_id", "players"),))

COUNTRIES = Contract("countries", _fields("""
    country_id integer
    country_name string*
    country_code string
    confederation string
    total_clubs integer
    total_players integer
    average_age number
    url string
"""), ("country_id",))

NATIONAL_TEAMS = Contract("national_teams", _fields("""
    national_team_id integer
    name string*
    team_code string
    country_id integer
    country_name string
    country_code string
    confederation string
    team_image_url string
    squad_size integer
    average_age number
    foreigners_number integer
    foreigners_percentage number
    total_market_value number  Aggregated market value of the squad in EUR.
    coach_name string
    fifa_ranking integer
    last_season integer
    url string
"""), ("national_team_id",), (_key("country_id", "countries"),))

CONTRACTS = {c.name: c for c in (
    COMPETITIONS, CLUBS, PLAYERS, GAMES, CLUB_GAMES, APPEARANCES, GAME_EVENTS, GAME_LINEUPS,
    PLAYER_VALUATIONS, TRANSFERS, COUNTRIES, NATIONAL_TEAMS)}
