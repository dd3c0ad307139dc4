"""Hand-written raw snapshots that hold every odd case the builders must cope with."""

import gzip
import json


def _href(kind, id_):
    return f"/x/profil/{kind}/{id_}"


def _ref(kind, id_):
    return {"href": _href(kind, id_)}


def club(id_, name, league="L1", **more):
    return {"type": "club", "href": f"/club-{id_}/startseite/verein/{id_}",
            "code": f"club-{id_}", "name": name,
            "parent": {"href": f"/liga/startseite/wettbewerb/{league}"}, **more}


def player(id_, **more):
    return {"href": f"/p/profil/spieler/{id_}", "code": f"p-{id_}",
            "parent": {"type": "club", "href": "/c/startseite/verein/10"},
            "name": "A", "last_name": "B", **more}


def game(id_, date, result="2:1", home=10, away=20, parent="/l/startseite/wettbewerb/L1", **more):
    return {"href": f"/spielbericht/index/spielbericht/{id_}", "parent": {"href": parent},
            "date": date, "result": result, "matchday": "1. Matchday",
            "home_club": {"href": f"/c/startseite/verein/{home}"},
            "away_club": {"href": f"/c/startseite/verein/{away}"}, **more}


def event(minute, kind, club_id, player_id, description, name=None, player_in=None):
    action = {"description": description}
    if player_in:
        action["player_in"] = _ref("spieler", player_in)
    return {"minute": minute, "type": kind,
            "club": {"href": f"/c/startseite/verein/{club_id}", "name": name},
            "player": _ref("spieler", player_id), "action": action}


GOAL = event(5, "Goals", 10, 1, "1. Goal")
SUB = event(60, "Substitutions", 30, 3, "Tactical", name="Seen In Events", player_in=4)


def lineup_player(id_, number="7", captain=0, **more):
    return {"number": number, "href": f"/p/profil/spieler/{id_}", "name": f"N{id_}",
            "team_captain": captain, "position": "Goalkeeper", **more}


def lineup(game_id, formation, home_start, away_subs=()):
    return {"game_id": game_id, "href": f"/spielbericht/aufstellung/spielbericht/{game_id}",
            "home_club": {"href": "/c/startseite/verein/10", "formation": formation,
                          "starting_lineup": home_start, "substitutes": []},
            "away_club": {"href": "/c/startseite/verein/20", "formation": None,
                          "substitutes": list(away_subs)}}


def appearance(player_id, game_id=None, result=None, code="L1", **more):
    row = {"href": f"/p/profil/spieler/{player_id}", "competition_code": code,
           "for": {"href": "/c/startseite/verein/10"},
           "goals": "1", "assists": "", "minutes_played": "90'", "yellow_cards": "12'",
           "second_yellow_cards": "", "red_cards": "", **more}
    if game_id is not None:
        row["game_id"] = game_id
    if result is not None:
        row["result"] = {"href": f"/spielbericht/index/spielbericht/{result}"}
    return row


def values(player_id, points):
    return {"player_id": player_id, "response": None if points is None else {"list": [
        {"datum_mw": d, "mw": v, "verein": c} for d, v, c in points]}}


def moves(player_id, rows):
    return {"player_id": player_id, "response": None if rows is None else {"transfers": [
        {"dateUnformatted": d, "season": "s", "from": {
            "href": f"/c/startseite/verein/{a}", "clubName": f"C{a}"},
         "to": {"href": f"/c/startseite/verein/{b}" if b else None, "clubName": f"C{b}"},
         "fee": fee, "marketValue": mv} for d, a, b, fee, mv in rows]}}


SEASONS = {
    "players": {
        2023: [player(1, name="Old", height="1,70 m"), player(3, name=" ", last_name="Solo")],
        2024: [
            player(1, name=" New ", last_name="Star", height="1,85 m", foot="right",
                   position="Attack - Left Winger", date_of_birth="Jan 01, 2000",
                   contract_expires="Jun 30, 2026", international_caps="12",
                   international_goals="", place_of_birth={"country": " Chile ", "city": "X"},
                   citizenship="Chile", player_agent={"name": "Agency"}),
            player(2, parent={"type": "national_team", "href": "/n/startseite/verein/99"},
                   current_club={"href": "/c/startseite/verein/20"}, foot="N/A",
                   position="Goalkeeper", date_of_birth="1999", height="null",
                   contract_expires="30/06/2027"),
            player(4, parent={"type": "national_team", "href": "/n/startseite/verein/99"},
                   position="Midfield", date_of_birth="N/A", contract_expires="Jun, 2026"),
            player(5, date_of_birth="05/08/2002", contract_expires="-",
                   position="Defender - Sweeper"),
        ]},
    "clubs": {
        2023: [club(10, "Old Ten"), club(20, "Twenty", squad_size="25", average_age="26.5",
                    foreigners_number="null", foreigners_percentage="55.6 %",
                    stadium_seats="81.044 Seats", total_market_value=1500000)],
        2024: [club(10, "Ten", foreigners_percentage=" %", foreigners_number="7", squad_size="",
                    total_market_value=None, national_team_players=3)]},
    "national_teams": {
        2024: [{"href": "/n/startseite/verein/99", "name": "", "code": "chile",
                "parent": {"country_name": "Chile", "country_id": "33"},
                "confederation": "South American Football Confederation",
                "squad_size": "23", "average_age": "", "foreigners_number": "null",
                "foreigners_percentage": "null", "total_market_value": "€105.35m",
                "fifa_ranking": "50"}]},
    "games": {
        2022: [game(100, "Sat, 05/08/23", home_club_position="Position: 5",
                    away_club_position="", attendance="Attendance: 45.123",
                    events=[GOAL, GOAL, SUB]),
               game(101, "Sat, 13/08/23", "-:-")],
        2023: [game(102, "Sat, 05/08/23", "0:0",
                    parent="/t/startseite/pokalwettbewerb/FIWC/saison_id/2023"),
               game(103, "null"), game(104, "garbage")],
        2024: [game(105, "Tue, 05/08/24", "1:3", home=10, away=30, home_club_position=None,
                    away_club_position="null",
                    events=[event(1, "Cards", 10, 1, "Yellow", name="Zeta")]),
               game(106, "Tue, 08/25/24", "3:3"),
               game(107, "Mon, 01/02/69", "1:0", home=40, away=20)]},
    "game_lineups": {
        2022: [lineup(100, "4-4-2", [lineup_player(1)])],
        2023: [lineup(100, "3-5-2", [lineup_player(1, "1 0", 1), lineup_player(1, "1 0", 1),
                                     lineup_player(1, "1 0", 1, extra="x")],
                      [lineup_player(2)]),
               lineup(103, "5-4-1", [lineup_player(5)])]},
    "appearances": {
        2022: [appearance(1, 100), appearance(2, result=101, goals="", red_cards="80'"),
               appearance(3, 100, code="ZZZ"), appearance(4), appearance(5, 103)],
        2023: [appearance(1, 102, second_yellow_cards="70'"),
               appearance(2, 102, yellow_cards=None, minutes_played="", goals=None)],
        2024: [appearance(9, 105)]},
}

API = {
    "market_values": {
        2023: [values(1, [("May 15, 2020", "€1.50m", "Ten"), ("May 15, 2020", "€900k", "Ten"),
                          ("01/07/2021", "€2.00m", "Ten"), ("-", "€9.00m", "Ten"),
                          ("Aug 01, 2021", "-", "Ten"), ("May 15, 5023", "€7.00m", "Ten"),
                          ("Jan 01, 2030", "€105.35m", "Ten"),
                          ("Jul 01, 2022", "€1.20bn", "Twenty")])],
        2024: [values(1, None), values(2, [("Jan 05, 2022", "€500Th", "Twenty")]),
               values(3, []), values(8, [("Jan 05, 2022", "£1.00m", "Nowhere")])],
        2025: [{"player_id": 2, "response": "null"}]},
    "transfers": {
        2023: [moves(1, [("2021-07-01", 10, 20, "€1.50m", "€350k"),
                         ("2022-01-01", 20, None, "free transfer", "-"),
                         ("2020-01-01", 5, 10, "loan transfer", "€125"),
                         ("0000-00-00", 1, 2, "-", "-"), ("", 1, 2, "-", "-"),
                         ("2021-07-01", 10, 20, "€9.00m", "?")])],
        2024: [moves(1, None), moves(8, [("2020-01-01", 1, 2, "?", "")])]},
}

PLAIN = {
    "competitions": [
        {"href": "/bundesliga/startseite/wettbewerb/L1", "competition_type": "first_tier",
         "country_id": "40", "country_name": "Germany", "country_code": "L1",
         "total_clubs": "18", "parent": {"href": "/wettbewerbe/europa"}},
        {"href": "/world-cup/startseite/pokalwettbewerb/FIWC", "competition_type": "world_cup",
         "parent": {"href": "/wettbewerbe/fifa"}},
        {"href": "/el/startseite/pokalwettbewerb/EL", "competition_type": "uefa_europa_league"},
        {"href": "/el/startseite/pokalwettbewerb/ELX", "competition_type": "europa_league"}],
    "countries": [
        {"href": "/wettbewerbe/national/wettbewerbe/33", "country_id": "33",
         "country_name": "Chile", "country_code": "CHI",
         "parent": {"href": "/wettbewerbe/amerika"}, "total_clubs": "16",
         "total_players": "", "average_age": "27.5"}],
}


def _lines(records):
    return "".join(json.dumps(r) + "\n" for r in records)


def write_snapshots(root):
    for tree, assets, suffix in (("scraper", SEASONS, ".json.gz"), ("api", API, ".json")):
        for asset, seasons in assets.items():
            for season, records in seasons.items():
                folder = root / tree / str(season)
                folder.mkdir(parents=True, exist_ok=True)
                path = folder / f"{asset}{suffix}"
                if suffix.endswith("gz"):
                    with gzip.open(path, "wt") as out:
                        out.write(_lines(records))
                else:
                    path.write_text(_lines(records))
    (root / "plain").mkdir()
    for asset, records in PLAIN.items():
        (root / "plain" / f"{asset}.json").write_text(_lines(records) + "\n")
