"""Builds that fail, go on and publish; lines that cannot be read; files that arrive."""

from pyspark.sql import Column, functions as F

from catalog import query
from catalog.league import SETTINGS, _raw, _sql
from pitchlake.plans import warehouse
from pitchlake.session import scratch
from pitchlake.streaming import arrivals

BROKEN = "c_custkey % 50 in (0, 1)"


def _players(t) -> dict:
    """Player lines, some of them broken, some with cells that cannot be read."""
    k = F.col("c_custkey")

    def text(every: int, odd: str, usual: str) -> Column:
        return F.when(k % every == 0, F.lit(odd)).otherwise(F.lit(usual))

    def link(prefix: str, id_: Column) -> Column:
        return F.concat(F.lit(prefix), id_.cast("string"))

    def line(parent: Column) -> Column:
        return F.to_json(F.struct(
            link("/p/profil/spieler/", k).alias("href"), parent.alias("parent"),
            F.col("c_name").alias("name"), text(7, "tall", "1,85 m").alias("height"),
            text(11, "31.31.2000", "Jan 1, 2000").alias("date_of_birth"),
            text(13, "many", "5").alias("international_caps")))

    club = F.struct(link("/c/startseite/verein/", F.col("c_nationkey")).alias("href"))
    value = (F.when(k % 50 == 0, F.concat(link('{"href": "/p/profil/spieler/', k), F.lit('", "na')))
             .when(k % 50 == 1, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
             .when(k % 50 == 2, line(F.lit("a club"))).otherwise(line(club)))
    return {"raw.players": t.customer.select(
        value.alias("value"), F.lit(2024).alias("season"), F.lit("raw/2024/lines.json").alias("filename"))}


def _found(t) -> tuple:
    raw, root = _players(t), scratch(t.spark, "build")
    tables = warehouse.run(raw, root, ["base_players"], SETTINGS)
    return raw, tables, warehouse.unreadable(raw, root, ["base_players"], SETTINGS)


def _count(check, table, column, condition):
    return f"""select '{check}' as "check", '{table}' as "table", '{column}' as "column",
        count(*) as failures from customer where {condition} having count(*) > 0"""


@query("unreadable_report", " union all ".join([
    _count("unreadable_line", "raw.players", "*", BROKEN),
    _count("unreadable_line", "raw.players", "part", "c_custkey % 50 = 2"),
    _count("unreadable_cell", "base_players", "height_in_cm", f"c_custkey % 7 = 0 and not {BROKEN}"),
    _count("unreadable_cell", "base_players", "date_of_birth", f"c_custkey % 11 = 0 and not {BROKEN}"),
    _count("unreadable_cell", "base_players", "international_caps",
           f"c_custkey % 13 = 0 and not {BROKEN}")]))
def unreadable_report(t):
    return _found(t)[2].filter("failures > 0").select("check", "table", "column", "failures")


@query("quarantine_lines", """
    select 'raw.players' as source, 2024 as season, 'raw/2024/lines.json' as filename,
           case c_custkey % 50 when 0 then '{"href": "/p/profil/spieler/' || c_custkey || '", "na'
               else '[' || c_custkey || ']' end as value
    from customer where c_custkey % 50 in (0, 1)""")
def quarantine_lines(t):
    raw, _, found = _found(t)
    return warehouse.quarantine(raw, found)


@query("players_of_broken_lines", f"""
    select c_custkey::integer as player_id, case when c_custkey % 50 = 2 then -1
               else c_nationkey::integer end as current_club_id,
           case when c_custkey % 7 <> 0 then 185 end as height_in_cm,
           case when c_custkey % 13 <> 0 then 5 end as international_caps
    from customer where not {BROKEN}""")
def players_of_broken_lines(t):
    return _found(t)[1]["base_players"].select(
        "player_id", "current_club_id", "height_in_cm", "international_caps")


@query("restarted_build", f"select *, 2 as taken_over from ({_sql('players')})")
def restarted_build(t):
    # The first build ends after the clubs; the second takes over both of its tables.
    raw, root = _raw(t, "players"), scratch(t.spark, "build")
    warehouse.run(raw, root, ["clubs"], SETTINGS)
    keys = warehouse.table_keys(raw, ["players", "clubs"], SETTINGS)
    taken = len(warehouse.Run(t.spark, root).finished(keys))
    warehouse.run(raw, root, ["players", "clubs"], SETTINGS)
    return warehouse.released(t.spark, root)["players"].withColumn("taken_over", F.lit(taken))


@query("arrivals_stream", """
    select event_id, user_id, case when event_id % 10 = 0 then 'revised' else event_type end as kind,
           week(ts)::integer as season, 2 as commits
    from events""")
def arrivals_stream(t):
    # Weeks stand for seasons. Some arrive first, the others with corrections of the first.
    root, store, seen = (scratch(t.spark, label) for label in ("inbox", "records", "seen"))
    week = F.weekofyear("ts")

    def arrive(rows, kind: Column) -> int:
        lines = rows.select(week.alias("week"), F.to_json(F.struct(
            F.concat(F.lit("/e/"), F.col("event_id").cast("string")).alias("href"), "event_id",
            "user_id", kind.alias("kind"))).alias("value"))
        lines.write.mode("append").option("compression", "gzip").partitionBy("week").text(root)
        return arrivals.follow(t.spark, f"{root}/*", "events", store, seen)

    revised = F.when(F.col("event_id") % 10 == 0, F.lit("revised")).otherwise(F.col("event_type"))
    arrive(t.events.filter(week % 2 == 0), F.col("event_type"))
    arrive(t.events.filter((week % 2 == 1) | (F.col("event_id") % 10 == 0)), revised)
    commits = arrivals.follow(t.spark, f"{root}/*", "events", store, seen)
    event = F.from_json("value", "event_id long, user_id long, kind string").alias("e")
    return arrivals.stored_lines(t.spark, store, "events").select(event, "season").select(
        "e.*", "season", F.lit(commits).alias("commits"))
