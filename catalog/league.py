"""The whole table graph on raw snapshots that Spark derives from the generated tables.

Every record is made from one row: customers become players, suppliers clubs, national
teams and countries, parts competitions, orders games with their events and line-ups,
lineitems appearances. The SQL states the expected table straight from those rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from catalog import query
from pitchlake.operators import quality as q
from pitchlake.plans.checks import history_checks, league_checks
from pitchlake.plans.settings import Settings
from pitchlake.plans.warehouse import BASE, CURATED, TABLES, plan
from pitchlake.session import scratch
from pitchlake.sinks.writers import write_table

SITE = "https://example.org"
AS_OF = "2024-06-30"
SETTINGS = Settings(site_root=SITE, as_of=AS_OF)


def _text(column) -> Column:
    return column.cast("string")


def _say(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _link(prefix: str, id_: Column, suffix: str = "") -> Column:
    return F.struct(_say(prefix, _text(id_), suffix).alias("href"))


def _club(id_: Column) -> Column:
    return _link("/c/startseite/verein/", id_)


def _person(id_: Column) -> Column:
    return _link("/p/profil/spieler/", id_)


def _pick(selector: Column, *options) -> Column:
    """Option number ``selector`` counted from zero; NULL beyond the last."""
    column = F.lit(None)
    for i, option in enumerate(options):
        column = F.when(selector == i, option if isinstance(option, Column) else F.lit(option)
                        ).otherwise(column)
    return column


def _each(numbers, item) -> Column:
    """Item of every number, as an array. Written out: Spark compiles it, but interprets a lambda."""
    return F.array(*[item(F.lit(i)) for i in numbers])


def _dotted(number: Column) -> Column:
    return F.regexp_replace(_text(number), r"(?<=\d)(?=(\d{3})+$)", ".")


def _cents(number: Column) -> Column:
    return _say(_text(F.floor(number / 100)), ".", F.lpad(_text(number % 100), 2, "0"))


# Rows that are worth a task of their own, and rows a task is given at most.
SMALL_TASK, LARGE_TASK = 10_000, 250_000


def _spread(df: DataFrame) -> DataFrame:
    """The same rows in tasks of bounded size.

    Generated tables are single files. Adaptive execution would size tasks by the narrow rows that
    it shuffles and not by the lines made of them, of which a task then sorts gigabytes.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, rows // SMALL_TASK), -(-rows // LARGE_TASK))
    return df.repartition(tasks, F.monotonically_increasing_id())


def _snapshots(df: DataFrame, seasons: Column, **fields: Column) -> DataFrame:
    """JSON lines, one per season of ``seasons``; fields may use ``season``."""
    rows = _spread(df).select("*", F.explode(seasons).alias("season"))
    record = F.to_json(F.struct(*[c.alias(n.rstrip("_")) for n, c in fields.items()]))
    path = _say("raw/", _text(F.col("season")), "/lines.json")
    return rows.select(record.alias("value"), F.col("season").cast("int").alias("season"),
                       path.alias("filename"))


def raw_competitions(t):
    k = F.col("p_partkey")
    copies = F.when(k % 10 == 0, F.array(F.lit(2020), F.lit(2020))).otherwise(F.array(F.lit(2020)))
    return _snapshots(
        t.part, copies,
        href=_say("/", F.replace("p_name", F.lit(" "), F.lit("-")), "/startseite/wettbewerb/P",
                  _text(k)),
        parent=_link("/wettbewerbe/", F.lower("p_type")),
        competition_type=_pick(k % 6, "first_tier", "domestic_cup", "uefa_champions_league",
                               "world_cup", "uefa_europa_league"),
        country_id=F.when(k % 4 != 0, _text(F.col("p_size"))),
        country_name=F.when(k % 4 != 0, F.col("p_brand")),
        country_code=F.when(k % 4 != 0, _say("C", _text(F.col("p_size")))),
        total_clubs=F.when(k % 5 != 0, _text(k % 20 + 2)))


BASE_SQL = {"base_competitions": f"""
    select 'P' || p_partkey as competition_id, replace(p_name, ' ', '-') as competition_code,
           replace(p_name, ' ', '-') as name,
           case p_partkey % 6 when 0 then 'first_tier' when 1 then 'domestic_cup'
               when 2 then 'uefa_champions_league' when 3 then 'world_cup'
               when 4 then 'uefa_europa_league' end as sub_type,
           case p_partkey % 6 when 0 then 'domestic_league' when 1 then 'domestic_cup'
               when 2 then 'international_cup' when 3 then 'national_team_competition'
               else 'other' end as type,
           case when p_partkey % 4 <> 0 then p_size else -1 end as country_id,
           case when p_partkey % 4 <> 0 then p_brand end as country_name,
           case when p_partkey % 4 <> 0 then 'C' || p_size end as domestic_league_code,
           lower(p_type) as confederation,
           case when p_partkey % 5 <> 0 then cast(p_partkey % 20 + 2 as integer) end as total_clubs,
           '{SITE}/' || replace(p_name, ' ', '-') || '/startseite/wettbewerb/P' || p_partkey as url
    from part"""}


def raw_countries(t):
    k = F.col("s_suppkey")
    copies = F.when(k % 10 == 0, F.array(F.lit(2020), F.lit(2020))).otherwise(F.array(F.lit(2020)))
    return _snapshots(
        t.supplier, copies, href=_say("/land/", _text(k)), country_id=_text(k),
        parent=F.struct(_say("/wettbewerbe/", _pick(k % 3, "europa", "asien", "afrika")).alias("href")),
        country_name=_say("Land ", _text(k)), country_code=_say("C", _text(k)),
        total_clubs=F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, _text(k % 50)),
        total_players=_text(k * 3),
        average_age=F.when(k % 4 == 0, F.lit("")).otherwise(_say(_text(k % 10 + 20), ".5")))


BASE_SQL["base_countries"] = f"""
    select cast(s_suppkey as integer) as country_id, 'Land ' || s_suppkey as country_name,
           'C' || s_suppkey as country_code,
           ['europa', 'asien', 'afrika'][s_suppkey % 3 + 1] as confederation,
           case when s_suppkey % 3 = 1 then cast(s_suppkey % 50 as integer) end as total_clubs,
           cast(s_suppkey * 3 as integer) as total_players,
           case when s_suppkey % 4 <> 0 then cast(s_suppkey % 10 + 20.5 as float) end as average_age,
           '{SITE}/land/' || s_suppkey as url
    from supplier"""


def raw_national_teams(t):
    k, newest = F.col("s_suppkey"), F.col("season") == 2024
    return _snapshots(
        t.supplier, F.array(F.lit(2022), F.lit(2024)),
        href=_say("/n/startseite/verein/", _text(k + 1000)),
        name=F.when(k % 4 == 0, F.lit("")).when(newest, _say("Team ", _text(k))).otherwise(F.lit("Old")),
        code=_say("team-", _text(k)),
        parent=F.struct(_say("Land ", _text(k)).alias("country_name"), _text(k).alias("country_id")),
        confederation=F.when(k % 3 == 0, F.lit("South American Football Confederation"))
            .otherwise(F.lit("UEFA")),
        team_image_url=_say("img/", _text(k)),
        squad_size=F.when(k % 5 == 0, F.lit("")).otherwise(_text(k % 5 + 20)),
        average_age=F.when(k % 6 == 0, F.lit("")).otherwise(_say(_text(k % 10 + 20), ".25")),
        foreigners_number=F.when(k % 2 == 0, F.lit("null")).otherwise(_text(k % 20)),
        foreigners_percentage=_pick(k % 4, "null", "%", _say(_text(k % 50), ".5 %")),
        total_market_value=F.when(k % 7 == 0, F.lit("-")).otherwise(
            _say("€", _cents(k * 12345 % 100000), _pick(k % 2, "m", "Th"))),
        coach_name=F.when(k % 3 != 0, _say("Coach ", _text(k))),
        fifa_ranking=F.when(k % 2 == 0, _text(k)).otherwise(F.lit("")))


BASE_SQL["base_national_teams"] = f"""
    select cast(s_suppkey + 1000 as integer) as national_team_id,
           case when s_suppkey % 4 = 0 then 'Land ' else 'Team ' end || s_suppkey as name,
           'team-' || s_suppkey as team_code, cast(s_suppkey as integer) as country_id,
           case when s_suppkey % 3 = 0 then 'CONMEBOL' else 'UEFA' end as confederation,
           'img/' || s_suppkey as team_image_url,
           case when s_suppkey % 5 <> 0 then cast(s_suppkey % 5 + 20 as integer) end as squad_size,
           case when s_suppkey % 6 <> 0 then cast(s_suppkey % 10 + 20.25 as float) end as average_age,
           case when s_suppkey % 2 = 0 then 0 else cast(s_suppkey % 20 as integer) end
               as foreigners_number,
           case when s_suppkey % 4 = 2 then cast(s_suppkey % 50 + 0.5 as float) end
               as foreigners_percentage,
           case when s_suppkey % 7 <> 0 then cast(
               cast(cast((s_suppkey * 12345 % 100000) as decimal(18,2)) / 100 as float)::double
               * case when s_suppkey % 2 = 0 then 1e6 else 1e3 end as integer) end
               as total_market_value,
           case when s_suppkey % 3 <> 0 then 'Coach ' || s_suppkey end as coach_name,
           case when s_suppkey % 2 = 0 then cast(s_suppkey as integer) end as fifa_ranking,
           2024 as last_season, 'raw/2024/lines.json' as filename,
           '{SITE}/n/startseite/verein/' || (s_suppkey + 1000) as url
    from supplier"""


def raw_clubs(t):
    k, newest = F.col("s_suppkey"), F.col("season") > 2020
    return _snapshots(
        t.supplier, F.array(F.lit(2020), F.lit(2023) + (k % 2).cast("int")),
        href=_say("/c/startseite/verein/", _text(k)), code=_say("club-", _text(k)),
        name=F.when(newest, F.col("s_name")).otherwise(F.lit("Old")),
        parent=_link("/l/startseite/wettbewerb/P", k % 40),
        total_market_value=F.when(k % 3 != 0, F.col("s_acctbal")),
        squad_size=F.when(k % 4 == 0, F.lit("")).otherwise(_text(k % 10 + 20)),
        average_age=_say(_text(k % 10 + 20), ".5"),
        foreigners_number=F.when(k % 3 == 0, F.lit("null")).when(k % 3 == 1, _text(k % 20)),
        foreigners_percentage=_pick(k % 5, "null", "%", "", _say(_text(k % 50), ".5 %")),
        national_team_players=k % 5, stadium_name=_say("Arena ", _text(k)),
        stadium_seats=_say(_dotted(k * 37 + 900), " Seats"),
        net_transfer_record=_say("+€", _text(k)),
        coach_name=F.when(k % 6 != 0, _say("Coach ", _text(k))))


BASE_SQL["base_clubs"] = f"""
    select cast(s_suppkey as integer) as club_id, 'club-' || s_suppkey as club_code,
           s_name as name, 'P' || (s_suppkey % 40) as domestic_competition_id,
           case when s_suppkey % 3 <> 0 then cast(s_acctbal as float) end as total_market_value,
           case when s_suppkey % 4 <> 0 then cast(s_suppkey % 10 + 20 as integer) end as squad_size,
           cast(s_suppkey % 10 + 20.5 as float) as average_age,
           case when s_suppkey % 3 = 1 then cast(s_suppkey % 20 as integer) else 0 end
               as foreigners_number,
           case when s_suppkey % 5 = 3 then cast(s_suppkey % 50 + 0.5 as float) end
               as foreigners_percentage,
           cast(s_suppkey % 5 as integer) as national_team_players,
           'Arena ' || s_suppkey as stadium_name,
           cast(s_suppkey * 37 + 900 as integer) as stadium_seats,
           '+€' || s_suppkey as net_transfer_record,
           case when s_suppkey % 6 <> 0 then 'Coach ' || s_suppkey end as coach_name,
           cast(2023 + s_suppkey % 2 as integer) as last_season,
           'raw/' || (2023 + s_suppkey % 2) || '/lines.json' as filename,
           '{SITE}/c/startseite/verein/' || s_suppkey as url
    from supplier"""


def raw_players(t):
    k, newest = F.col("c_custkey"), F.col("season") > 2021
    born = F.date_add(F.lit("1980-01-01").cast("date"), (k % 9000).cast("int"))
    ends = F.date_add(F.lit("2024-01-01").cast("date"), (k % 900).cast("int"))
    team = k % 5 == 0
    parent = F.struct(
        F.when(team, F.lit("national_team")).otherwise(F.lit("club")).alias("type"),
        _say("/x/startseite/verein/", _text(F.when(team, F.col("c_nationkey") + 1000)
                                            .otherwise(k % 97))).alias("href"))
    return _snapshots(
        t.customer, F.array(F.lit(2021), F.lit(2022) + (k % 3).cast("int")),
        href=_say("/p/profil/spieler/", _text(k)), code=_say("p-", _text(k)), parent=parent,
        current_club=F.when(k % 10 == 0, _club(k % 97)),
        name=F.when(~newest, F.lit("Old")).when(k % 7 == 0, F.lit(" "))
            .otherwise(_say(" First", _text(k), " ")),
        last_name=F.col("c_name"),
        place_of_birth=F.struct(_say(" ", F.col("c_mktsegment")).alias("country"),
                                _say("City", _text(k % 9), " ").alias("city")),
        citizenship=_say(F.col("c_mktsegment"), " "),
        date_of_birth=_pick(k % 4, F.date_format(born, "MMM dd, yyyy"),
                            F.date_format(born, "dd/MM/yyyy"), F.date_format(born, "yyyy"), "N/A"),
        position=_pick(k % 6, "Goalkeeper", "Attack - Left Winger", "Defender - Centre-Back",
                       "Midfield - Central Midfield", "Defender - Sweeper"),
        foot=_pick(k % 3, "right", "N/A"),
        height=F.when(k % 8 == 0, F.lit("null")).otherwise(
            _say("1,", F.lpad(_text(k % 100), 2, "0"), " m")),
        contract_expires=_pick(k % 4, F.date_format(ends, "dd/MM/yyyy"),
                               F.date_format(ends, "MMM d, yyyy"), F.date_format(ends, "MMM, yyyy"),
                               "-"),
        player_agent=F.when(k % 2 == 0, F.struct(_say("Agency ", _text(k % 11)).alias("name"))),
        image_url=_say("img/", _text(k)),
        international_caps=F.when(k % 2 == 0, _text(k % 130)).otherwise(F.lit("")),
        international_goals=F.when(k % 3 == 0, _text(k % 40)))


BASE_SQL["base_players"] = f"""
    select cast(c_custkey as integer) as player_id,
           case when c_custkey % 7 <> 0 then 'First' || c_custkey end as first_name,
           c_name as last_name,
           case when c_custkey % 7 <> 0 then 'First' || c_custkey || ' ' else '' end || c_name as name,
           cast(2022 + c_custkey % 3 as integer) as last_season,
           case when c_custkey % 10 = 0 or c_custkey % 5 <> 0 then cast(c_custkey % 97 as integer)
               else -1 end as current_club_id,
           'p-' || c_custkey as player_code, c_mktsegment as country_of_birth,
           'City' || (c_custkey % 9) as city_of_birth, c_mktsegment as country_of_citizenship,
           case c_custkey % 4 when 2 then date_trunc('year', born)::date when 3 then null else born
               end as date_of_birth,
           case c_custkey % 6 when 0 then 'Goalkeeper' when 1 then 'Left Winger'
               when 2 then 'Centre-Back' when 3 then 'Central Midfield' when 4 then 'Sweeper'
               end as sub_position,
           case c_custkey % 6 when 0 then 'Goalkeeper' when 1 then 'Attack' when 2 then 'Defender'
               when 3 then 'Midfield' else 'Missing' end as position,
           case c_custkey % 3 when 0 then 'right' end as foot,
           case when c_custkey % 8 <> 0 then cast(100 + c_custkey % 100 as integer) end as height_in_cm,
           case c_custkey % 4 when 2 then date_trunc('month', ends)::date when 3 then null else ends
               end as contract_expiration_date,
           case when c_custkey % 2 = 0 then 'Agency ' || (c_custkey % 11) end as agent_name,
           'img/' || c_custkey as image_url,
           case when c_custkey % 2 = 0 then cast(c_custkey % 130 as integer) end as international_caps,
           case when c_custkey % 3 = 0 then cast(c_custkey % 40 as integer) end as international_goals,
           case when c_custkey % 5 = 0 then c_nationkey + 1000 end as current_national_team_id,
           '{SITE}/p/profil/spieler/' || c_custkey as url
    from (select *, date '1980-01-01' + cast(c_custkey % 9000 as integer) as born,
                 date '2024-01-01' + cast(c_custkey % 900 as integer) as ends from customer)"""


def _home(): return F.col("o_custkey") % 97
def _away(): return (F.col("o_custkey") + F.col("o_orderkey") % 3 + 1) % 120


def raw_games(t):
    k, day, season = F.col("o_orderkey"), F.col("o_orderdate"), F.col("season")
    tournament = k % 9 == 0
    day_first = (season >= 2024) | tournament
    position = _pick(k % 4, _say("Position: ", _text(k % 20 + 1)), "", "null")

    def event(i: Column) -> Column:
        club = F.when(i == 3, k % 50 + 500).otherwise(_home())
        return F.struct(
            ((k + i) % 90).alias("minute"), _pick(i % 3, "Cards", "Goals", "Substitutions").alias("type"),
            F.struct(_say("/c/startseite/verein/", _text(club)).alias("href"),
                     F.when(i != 2, _say("Seen ", _text(club))).alias("name")).alias("club"),
            _person((F.col("o_custkey") + i) % 1700).alias("player"),
            F.struct(F.when(i == 1, F.lit("1. Goal")).alias("description"),
                     F.when(i == 2, _person(k % 1000)).alias("player_in"),
                     F.when(i == 1, _person(k % 900)).alias("player_assist")).alias("action"))

    # One to three events, the first of them twice.
    written = F.lit(None)
    for more in (2, 1, 0):
        written = F.when(k % 3 == more, _each([*range(1, more + 2), 1], event)).otherwise(written)
    # Keys below zero count down instead.
    down = F.transform(F.concat(F.sequence(F.lit(1), k % 3 + 1), F.array(F.lit(1).cast("long"))), event)
    events = F.when(k % 3 < 0, down).otherwise(written)
    newest = F.lit(2018) + (k % 8).cast("int")
    return _snapshots(
        t.orders, F.when(k % 4 == 0, F.array(F.lit(2012), newest)).otherwise(F.array(newest)),
        href=_say("/s/index/spielbericht/", _text(k)),
        parent=F.struct(_say("/l/startseite/wettbewerb/P", _text(k % 40),
                             F.when(tournament, F.lit("/saison_id/2020")).otherwise(F.lit(""))).alias("href")),
        matchday=_say(_text(k % 34), ". Matchday"),
        date=F.when(k % 50 == 0, F.lit("null")).otherwise(_say(
            F.date_format(day, "EEE, "), F.when(day_first, F.date_format(day, "dd/MM/yy"))
            .otherwise(F.date_format(day, "MM/dd/yy")))),
        home_club=_club(_home()), away_club=_club(_away()),
        result=F.when(season == 2012, F.lit("9:9")).when(k % 10 == 3, F.lit("-:-")).otherwise(
            _say(_text(k % 5), ":", _text(F.col("o_custkey") % 4))),
        home_club_position=position, away_club_position=position,
        home_manager=F.struct(_say("Boss ", _text(_home())).alias("name")),
        away_manager=F.when(k % 2 == 0, F.struct(_say("Boss ", _text(_away())).alias("name"))),
        stadium=_say("Arena ", _text(_home())),
        attendance=_say("Attendance: ", _dotted(k * 3 + 5)),
        referee=F.when(k % 3 != 0, _say("Ref ", _text(k % 77))), events=events)


def raw_game_lineups(t):
    k, newest = F.col("o_orderkey"), F.col("season") == 2021

    def entry(i: Column) -> Column:
        return F.struct(
            _say(" ", _text(i), " ", _text(k % 10)).alias("number"),
            _say("/p/profil/spieler/", _text((F.col("o_custkey") + i) % 1700)).alias("href"),
            _say("N", _text((F.col("o_custkey") + i) % 1700)).alias("name"),
            (i == 1).cast("int").alias("team_captain"),
            F.when(i != 3, _say("Pos ", _text(i))).alias("position"))

    def entries(low: int, high: int, again: bool = False) -> Column:
        return _each([*range(low, high + 1)] * (2 if again else 1), entry)

    # Every sixth game has no formation and an empty list for a starting line-up.
    known = k % 6 != 0
    nobody = F.slice(entries(1, 1), 1, 0)
    home = F.struct(_say("/c/startseite/verein/", _text(_home())).alias("href"),
                    F.when(known & ~newest, F.lit("4-4-2")).when(known & (k % 5 != 0), F.lit("4-3-3"))
                    .alias("formation"),
                    F.when(newest, F.when(known, entries(1, 2, True)).otherwise(nobody))
                    .alias("starting_lineup"),
                    entries(5, 5).alias("substitutes"))
    away = F.struct(_say("/c/startseite/verein/", _text(_away())).alias("href"),
                    F.when(known, F.lit("3-5-2")).alias("formation"),
                    entries(3, 4).alias("substitutes"))
    return _snapshots(t.orders, F.array(F.lit(2019), F.lit(2021)),
                      game_id=k, home_club=home, away_club=away)


GAMES_FROM = """(select *, o_custkey % 97 as home, (o_custkey + o_orderkey % 3 + 1) % 120 as away
                 from orders)"""

BASE_SQL["base_games"] = f"""
    select cast(o_orderkey as integer) as game_id, 'P' || (o_orderkey % 40) as competition_id,
           cast(2018 + o_orderkey % 8 as integer) as season, (o_orderkey % 34) || '. Matchday' as round,
           cast(o_orderdate as date) as date, cast(home as integer) as home_club_id,
           cast(away as integer) as away_club_id,
           case when o_orderkey % 10 <> 3 then cast(o_orderkey % 5 as integer) end as home_club_goals,
           case when o_orderkey % 10 <> 3 then cast(o_custkey % 4 as integer) end as away_club_goals,
           case o_orderkey % 4 when 0 then cast(o_orderkey % 20 + 1 as integer) when 1 then -1
               when 2 then -1 end as home_club_position,
           case o_orderkey % 4 when 0 then cast(o_orderkey % 20 + 1 as integer) when 1 then -1
               when 2 then -1 end as away_club_position,
           'Boss ' || home as home_club_manager_name,
           case when o_orderkey % 2 = 0 then 'Boss ' || away end as away_club_manager_name,
           'Arena ' || home as stadium, cast(o_orderkey * 3 + 5 as integer) as attendance,
           case when o_orderkey % 3 <> 0 then 'Ref ' || (o_orderkey % 77) end as referee,
           '{SITE}/s/index/spielbericht/' || o_orderkey as url,
           case when o_orderkey % 6 <> 0 and o_orderkey % 5 <> 0 then '4-3-3' end as home_club_formation,
           case when o_orderkey % 6 <> 0 then '3-5-2' end as away_club_formation
    from {GAMES_FROM} where o_orderkey % 50 <> 0"""

BASE_SQL["base_game_events"] = f"""
    select cast(o_orderkey as integer) as game_id, cast((o_orderkey + i) % 90 as integer) as minute,
           ['Cards', 'Goals', 'Substitutions'][i % 3 + 1] as type,
           cast(case when i = 3 then o_orderkey % 50 + 500 else home end as integer) as club_id,
           case when i <> 2 then 'Seen ' || (case when i = 3 then o_orderkey % 50 + 500 else home end)
               end as club_name,
           cast((o_custkey + i) % 1700 as integer) as player_id,
           case when i = 1 then '1. Goal' end as description,
           case when i = 2 then cast(o_orderkey % 1000 as integer) end as player_in_id,
           case when i = 1 then cast(o_orderkey % 900 as integer) end as player_assist_id
    from {GAMES_FROM}, (values (1), (2), (3)) as n(i) where i <= o_orderkey % 3 + 1"""

BASE_SQL["base_game_lineups"] = f"""
    select cast(o_orderkey as integer) as game_id,
           cast(case when i in (3, 4) then away else home end as integer) as club_id,
           case when i <= 2 then 'starting_lineup' else 'substitutes' end as type,
           i || '' || (o_orderkey % 10) as number,
           cast((o_custkey + i) % 1700 as integer) as player_id,
           'N' || ((o_custkey + i) % 1700) as player_name,
           case when i = 1 then 1 else 0 end as team_captain,
           case when i <> 3 then 'Pos ' || i end as position
    from {GAMES_FROM}, (values (1), (2), (3), (4), (5)) as n(i) where o_orderkey % 6 <> 0 or i > 2"""


def raw_appearances(t):
    player, game = F.col("l_partkey"), F.col("l_orderkey")
    both = player + game
    return _snapshots(
        t.lineitem, F.array(F.lit(2020)),
        href=_say("/p/profil/spieler/", _text(player)),
        game_id=F.when(game % 3 == 0, game),
        result=F.when(game % 3 == 1, _link("/s/index/spielbericht/", game)),
        competition_code=_pick(game % 4, "ES1", "GB1", "ZZZ", "FIWC"),
        for_=_club(both % 97),
        goals=_pick(both % 4, "", "1", "2"), assists=_pick(both % 3, "", "1"),
        minutes_played=F.when(both % 5 == 0, F.lit("")).otherwise(_say(_text(both % 90), "'")),
        yellow_cards=_pick(both % 3, "", "10'"), second_yellow_cards=_pick(both % 2, "", "70'"),
        red_cards=_pick(both % 7, "80'", ""))


BASE_SQL["base_appearances"] = """
    select distinct cast(l_partkey as integer) as player_id, cast(l_orderkey as integer) as game_id,
           l_orderkey || '_' || l_partkey as appearance_id,
           ['ES1', 'GB1', 'ZZZ', 'FIWC'][l_orderkey % 4 + 1] as competition_id,
           cast(s % 97 as integer) as player_club_id,
           case s % 4 when 0 then 0 when 1 then 1 when 2 then 2 end as goals,
           case s % 3 when 0 then 0 when 1 then 1 end as assists,
           case when s % 5 = 0 then 0 else cast(s % 90 as integer) end as minutes_played,
           case s % 3 when 0 then 0 when 1 then 1 end + case s % 2 when 0 then 0 else 1 end
               as yellow_cards,
           case s % 7 when 0 then 1 else 0 end as red_cards
    from (select *, l_partkey + l_orderkey as s from lineitem)
    where l_orderkey % 4 <> 2 and l_orderkey % 3 <> 2
      and l_orderkey in (select game_id from base_games)"""


def raw_market_values(t):
    k, season = F.col("c_custkey"), F.col("season")
    start = F.date_add(F.lit("2015-01-01").cast("date"), (k % 500).cast("int"))
    raise_ = F.when(season == 2024, F.lit(1)).otherwise(F.lit(0))

    def point(i: Column) -> Column:
        day = F.date_add(start, F.when(i == 5, F.lit(90)).otherwise(i * 90).cast("int"))
        date = (F.when(i == 6, F.lit("Jan 01, 2099")).when(i == 7, F.lit("May 15, 5023"))
                .when(i == 8, F.lit("-")).when(i % 2 == 1, F.date_format(day, "MMM dd, yyyy"))
                .otherwise(F.date_format(day, "dd/MM/yyyy")))
        amount = F.when((i == 3) & (k % 2 == 0), F.lit("-")).otherwise(_say(
            "€", _text(k % 90 + i + raise_), ".35", F.when(i == 2, F.lit("k")).when(
                i == 4, F.lit("bn")).otherwise(F.lit("m"))))
        return F.struct(date.alias("datum_mw"), amount.alias("mw"), _say("Club", _text(i)).alias("verein"))

    points = F.struct(_each(range(1, 9), point).alias("list"))
    # Two of three players have a newer snapshot, a failed one for the first of them.
    seasons = F.when(k % 3 == 2, F.array(F.lit(2022))).otherwise(F.array(F.lit(2022), F.lit(2024)))
    return _snapshots(t.customer, seasons, player_id=k,
                      response=F.when((k % 3 != 0) | (season != 2024), points))


BASE_SQL["base_market_values"] = f"""
    select cast(c_custkey as integer) as player_id,
           case when i <> 4 then cast(cast((c_custkey % 90 + i + newer) || '.35' as float)::double
               * case when i = 2 then 1e3 else 1e6 end as integer) end as market_value_in_eur,
           case when i = 6 then 'Jan 01, 2099'
                when i % 2 = 1 then strftime(day, '%b %d, %Y') else strftime(day, '%d/%m/%Y')
               end as datetime_str,
           case when i = 6 then date '{AS_OF}' else day end as date,
           'Club' || i as current_club_name, cast(2022 + 2 * newer as integer) as last_season,
           'raw/' || (2022 + 2 * newer) || '/lines.json' as filename
    from (select *, cast(date '2015-01-01' + cast(c_custkey % 500 + 90 * i as integer) as date) as day,
                 case when c_custkey % 3 = 1 then 1 else 0 end as newer
          from customer, (values (1), (2), (3), (4), (6)) as n(i))
    where not (i = 3 and c_custkey % 2 = 0)"""


def raw_transfers(t):
    k, season = F.col("c_custkey"), F.col("season")
    start = F.date_add(F.lit("2015-03-01").cast("date"), (k % 500).cast("int"))

    def move(i: Column) -> Column:
        n = F.when(i == 4, F.lit(1)).otherwise(i)
        date = (F.when(i == 5, F.lit("0000-00-00")).when(i == 6, F.lit(""))
                .otherwise(_text(F.date_add(start, (n * 100).cast("int")))))
        target = F.when(~((n == 2) & (k % 5 == 0)), k % 97 + n + 1)
        return F.struct(
            date.alias("dateUnformatted"), F.lit("14/15").alias("season"),
            F.struct(_say("/c/startseite/verein/", _text(k % 97 + n)).alias("href"),
                     _say("Club ", _text(k % 97 + n)).alias("clubName")).alias("from"),
            F.struct(_say("/c/startseite/verein/", _text(target)).alias("href"),
                     _say("Club ", _text(target)).alias("clubName")).alias("to"),
            F.when(i == 1, _say("€", _cents(k % 1000), "m")).when(i == 2, F.lit("free transfer"))
                .when(i == 4, F.lit("€9.00m")).otherwise(F.lit("?")).alias("fee"),
            F.when(i == 1, _say("€", _text(k % 1000), "k")).when(i == 2, F.lit("€77"))
                .otherwise(F.lit("-")).alias("marketValue"))

    moves = F.struct(_each(range(1, 7), move).alias("transfers"))
    seasons = F.when(k % 2 == 0, F.array(F.lit(2022), F.lit(2024))).otherwise(F.array(F.lit(2022)))
    return _snapshots(t.customer, seasons, player_id=k, response=F.when(season == 2022, moves))


BASE_SQL["base_transfers"] = """
    select cast(c_custkey as integer) as player_id,
           cast(date '2015-03-01' + cast(c_custkey % 500 + 100 * i as integer) as date) as transfer_date,
           '14/15' as transfer_season, cast(c_custkey % 97 + i as integer) as from_club_id,
           case when not (i = 2 and c_custkey % 5 = 0) then cast(c_custkey % 97 + i + 1 as integer)
               end as to_club_id,
           'Club ' || (c_custkey % 97 + i) as from_club_name,
           case when not (i = 2 and c_custkey % 5 = 0) then 'Club ' || (c_custkey % 97 + i + 1)
               end as to_club_name,
           case i when 1 then cast((c_custkey % 1000) * 10000 as decimal(18,3))
                  when 2 then cast(0 as decimal(18,3)) end as transfer_fee,
           case i when 1 then cast((c_custkey % 1000) * 1000 as decimal(18,3))
                  when 2 then cast(77 as decimal(18,3)) end as market_value_in_eur,
           'raw/2022/lines.json' as source_filename
    from customer, (values (1), (2), (3)) as n(i)"""

SOURCES = {
    "competitions": raw_competitions, "countries": raw_countries,
    "national_teams": raw_national_teams, "clubs": raw_clubs, "players": raw_players,
    "games": raw_games, "game_lineups": raw_game_lineups, "appearances": raw_appearances,
    "market_values": raw_market_values, "transfers": raw_transfers,
}

CURATED_SQL = {
    "competitions": "select * from base_competitions",
    "countries": "select * from base_countries",
    "clubs": "select * from base_clubs",
    "national_teams": """
        select n.* exclude (filename), country_name, country_code
        from base_national_teams n left join base_countries c on c.country_id = n.country_id""",
    "players": """
        select p.*, c.domestic_competition_id as current_club_domestic_competition_id,
               c.name as current_club_name,
               (select arg_max(coalesce(market_value_in_eur, -1), date) from base_market_values v
                where v.player_id = p.player_id) as market_value_in_eur,
               (select max(market_value_in_eur) from base_market_values v
                where v.player_id = p.player_id) as highest_market_value_in_eur
        from base_players p left join base_clubs c on c.club_id = p.current_club_id""",
    "games": """
        select g.*,
               coalesce(h.name, (select min(club_name) from base_game_events e
                                 where e.club_id = g.home_club_id)) as home_club_name,
               coalesce(a.name, (select min(club_name) from base_game_events e
                                 where e.club_id = g.away_club_id)) as away_club_name,
               home_club_goals || ':' || away_club_goals as aggregate, c.type as competition_type
        from base_games g left join base_competitions c on c.competition_id = g.competition_id
        left join base_clubs h on h.club_id = home_club_id
        left join base_clubs a on a.club_id = away_club_id""",
    "club_games": """
        select game_id, 'Home' as hosting, home_club_id as club_id, away_club_id as opponent_id,
               home_club_goals as own_goals, away_club_goals as opponent_goals,
               home_club_position as own_position, away_club_position as opponent_position,
               home_club_manager_name as own_manager_name,
               away_club_manager_name as opponent_manager_name,
               coalesce(cast(home_club_goals > away_club_goals as integer), 0) as is_win
        from base_games
        union all by name
        select game_id, 'Away' as hosting, away_club_id as club_id, home_club_id as opponent_id,
               away_club_goals as own_goals, home_club_goals as opponent_goals,
               away_club_position as own_position, home_club_position as opponent_position,
               away_club_manager_name as own_manager_name,
               home_club_manager_name as opponent_manager_name,
               coalesce(cast(away_club_goals > home_club_goals as integer), 0) as is_win
        from base_games""",
    "appearances": """
        select a.*, g.date, p.name as player_name,
               coalesce(p.current_club_id, -1) as player_current_club_id
        from base_appearances a left join base_games g on g.game_id = a.game_id
        left join base_players p on p.player_id = a.player_id""",
    "game_events": """
        select e.*, g.date, md5(concat_ws('-', e.game_id, e.player_id, e.club_id, e.type, e.minute,
                   coalesce(e.description, '_dbt_utils_surrogate_key_null_'),
                   coalesce(e.player_in_id::varchar, '_dbt_utils_surrogate_key_null_'),
                   coalesce(e.player_assist_id::varchar, '_dbt_utils_surrogate_key_null_')))
                   as game_event_id
        from base_game_events e left join base_games g on g.game_id = e.game_id""",
    "game_lineups": """
        select l.*, g.date, md5(concat_ws('-', l.game_id, l.player_id, l.type,
                   coalesce(l.position, '_dbt_utils_surrogate_key_null_'), l.number,
                   l.team_captain)) as game_lineups_id
        from base_game_lineups l join base_games g on g.game_id = l.game_id""",
    "player_valuations": """
        with moved as (
            select v.player_id, v.date, t.to_club_id, row_number() over (
                partition by v.player_id, v.date order by t.transfer_date desc) as n
            from base_market_values v join base_transfers t
              on t.player_id = v.player_id and t.transfer_date <= v.date),
        placed as (
            select v.player_id, v.date, v.market_value_in_eur, v.current_club_name,
                   coalesce(m.to_club_id, p.current_club_id) as current_club_id
            from base_market_values v
            left join moved m on m.player_id = v.player_id and m.date = v.date and m.n = 1
            left join base_players p on p.player_id = v.player_id)
        select placed.*, c.domestic_competition_id as player_club_domestic_competition_id
        from placed left join base_clubs c on c.club_id = placed.current_club_id""",
    "transfers": """
        select t.* exclude (source_filename), p.name as player_name
        from base_transfers t join base_players p on p.player_id = t.player_id""",
}


def _sql(table: str) -> str:
    """Expected table with every base table below it as a named subquery."""
    needed, waiting = {}, [table]
    while waiting:
        name = waiting.pop()
        waiting += [i for i in TABLES[name].inputs if i in TABLES]
        if name in BASE_SQL:
            needed[name] = BASE_SQL[name]
    body = needed.pop(table) if table in BASE_SQL else CURATED_SQL[table]
    ordered = sorted(needed, key=lambda n: n == "base_appearances")
    heads = ", ".join(f"{n} as ({needed[n]})" for n in ordered)
    return f"with {heads}\nselect * from ({body})" if heads else body


def _raw(t, table: str) -> dict[str, DataFrame]:
    needed, waiting = {}, [table]
    while waiting:
        for name in TABLES[waiting.pop()].inputs:
            if name in TABLES:
                waiting.append(name)
            else:
                needed[name] = SOURCES[name.removeprefix("raw.")](t)
    return needed


# Tables whose builder goes over some inputs more than once.
REREAD = {"player_valuations": {"base_market_values", "base_transfers"}}


def _shared(table: str) -> set[str]:
    """Tables below ``table`` that are read more than once."""
    readers: dict[str, set[str]] = {}
    waiting = [table]
    while waiting:
        name = waiting.pop()
        for needed in TABLES[name].inputs:
            if needed in TABLES:
                readers.setdefault(needed, set()).add(name)
                waiting.append(needed)
    return {n for n, users in readers.items() if len(users) > 1} | REREAD.get(table, set())


def _register(table: str) -> None:
    shared = _shared(table)

    @query(f"table_{table}", _sql(table))
    def build(t):
        # As in a full run, a table read more than once is written and read back.
        def keep(name, df):
            return write_table(df, scratch(t.spark, name)) if name in shared else df

        return plan(_raw(t, table), [table], SETTINGS, keep)[table]


for _table in (*BASE, *CURATED):
    _register(_table)


def _metric(check: str, table: str, column: str, rows: str, severity: str = "error") -> str:
    return f"""select '{check}' as "check", '{table}' as "table", '{column}' as "column",
        '{severity}' as severity, count(*) as failures, cast(null as varchar) as detail
        from ({rows})"""


# Relations that the checks of leagues share, and the checks.
LEAGUE_SQL = """
    leagues as (select * from base_competitions where sub_type = 'first_tier'),
    per_season as (
        select competition_id, season, count(distinct game_id) as n,
               count(distinct home_club_id) as clubs
        from base_games group by 1, 2)"""
LEAGUE_METRICS = [
        _metric("games_per_matchday", "games", "round", """
            select 1 from base_games
            where competition_id in (select competition_id from leagues) and season <> 2025
            group by round, season, competition_id having count(*) < 9"""),
        _metric("clubs_per_league", "clubs", "domestic_competition_id", """
            select 1 from leagues l left join base_clubs c
                on c.domestic_competition_id = l.competition_id
            group by competition_id, l.total_clubs
            having l.total_clubs is null or count(distinct club_id) < l.total_clubs"""),
        _metric("double_round_robin", "games", "season", """
            select 1 from per_season
            where competition_id in (select competition_id from leagues)
              and season <> (select max(season) from base_games)
              and competition_id in (
                  select competition_id from per_season group by 1 having count(*) > 1)
              and n <> clubs * (clubs - 1)"""),
        _metric("number_of_leagues", "competitions", "sub_type", """
            select count(*) from leagues having count(*) not between 31 and 32"""),
        _metric("null_responses", "raw.market_values", "response", """
            select 1 from customer where c_custkey % 3 <> 2
            having 100.0 * count(*) filter (where c_custkey % 3 = 0) / count(*) > 10""", "warn"),
        _metric("lost_history", "base_transfers", "player_id", "select 1 from customer where false"),
]


@query("league_report", f"""
    with base_games as ({BASE_SQL["base_games"]}), base_clubs as ({BASE_SQL["base_clubs"]}),
    base_competitions as ({BASE_SQL["base_competitions"]}), {LEAGUE_SQL}
    """ + " union all ".join(LEAGUE_METRICS))
def league_report(t):
    names = ["games", "clubs", "competitions", "transfers"]
    raw = {k: v for n in names for k, v in _raw(t, f"base_{n}").items()}
    raw["raw.market_values"] = raw_market_values(t)
    base = plan(raw, [f"base_{n}" for n in names], SETTINGS,
                lambda name, df: write_table(df, scratch(t.spark, name)))
    tables = base | {n: base[f"base_{n}"] for n in names}
    return q.report(league_checks(tables) + history_checks(tables, raw))
