"""Data checks on the generated tables, as metric rows or failing rows."""

from pyspark.sql import functions as F

from catalog import query
from pitchlake.functions.text import to_int
from pitchlake.operators import contract, quality as q
from pitchlake.operators.snapshot import latest
from pitchlake.session import scratch


def _row(check, table, column, failures, detail="cast(null as varchar)", severity="error"):
    return f"""select '{check}' as "check", '{table}' as "table", '{column}' as "column",
        '{severity}' as severity, cast({failures} as bigint) as failures, {detail} as detail"""


@query("dq_unique", f"""
    {_row("unique", "orders", "o_orderkey", "count(*)")}
    from (select o_orderkey from orders group by 1 having count(*) > 1)
    union all
    {_row("unique", "lineitem", "l_orderkey,l_linenumber", "count(*)")}
    from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)
    union all
    {_row("unique", "events", "user_id", "count(*)")}
    from (select case when user_id % 5 = 0 then null else user_id end as u from events
          group by 1 having count(*) > 1) where u is not null""")
def dq_unique(t):
    user = F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id")
    return q.report([
        q.verdict(q.duplicates(t.orders, ["o_orderkey"]), "unique", "orders", "o_orderkey"),
        q.verdict(q.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"]), "unique",
                  "lineitem", "l_orderkey,l_linenumber"),
        q.verdict(q.duplicates(t.events.select(user), ["user_id"]), "unique", "events",
                  "user_id")])


EVENT_RULES = """
    with e as (select nullif(event_type, 'error') as kind, value, ts from events)
"""


@query("dq_row_rules", EVENT_RULES + " union all ".join(f"{row} from e" for row in (
    _row("not_null", "events", "kind", "count(*) filter (where kind is null)"),
    _row("accepted_values", "events", "kind",
         "count(*) filter (where kind not in ('view', 'click', 'signup'))"),
    _row("values_not_in", "events", "kind", "count(*) filter (where kind in ('click'))"),
    _row("values_between", "events", "value",
         "count(*) filter (where value < 1 or value > 50)"),
    _row("values_between", "events", "ts",
         "count(*) filter (where ts < timestamp '2024-01-03')"),
    _row("missing_share", "events", "kind",
         "(count(*) - count(kind)) / count(*) > 0.15",
         "printf('%.4f', (count(*) - count(kind)) / count(*))"),
    _row("row_count", "events", "*", "count(*) not between 100 and 5000",
         "cast(count(*) as varchar)"))))
def dq_row_rules(t):
    events = t.events.select(F.nullif("event_type", F.lit("error")).alias("kind"), "value", "ts")
    return q.measure(events, "events", [
        q.not_null("kind"), q.accepted_values("kind", ["view", "click", "signup"]),
        q.values_not_in("kind", ["click"]), q.values_between("value", 1, 50),
        q.values_between("ts", F.lit("2024-01-03").cast("timestamp_ntz")),
        q.missing_share("kind", 0.15), q.row_count_between(100, 5000)])


@query("dq_columns", " union all ".join([
    _row("columns_contain", "orders", "*", "2 + 0 * count(*)", "'o_clerk, o_comment'") + " from orders",
    _row("not_null", "orders", "o_custkey", "count(*) filter (where o_custkey is null)") + " from orders",
    _row("row_count", "orders", "*", "count(*) not between 1 and 100", "cast(count(*) as varchar)")
    + " from orders"]))
def dq_columns(t):
    return q.report([
        q.missing_columns(t.orders, "orders", ["o_orderkey", "o_clerk", "o_custkey", "o_comment"]),
        q.measure(t.orders, "orders", [q.not_null("o_custkey"), q.row_count_between(1, 100)])])


LINKS = [
    contract.Contract("lineitem", (), (), (
        contract.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        contract.ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)))),
    contract.Contract("orders", (), (), (
        contract.ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)),
]


def _fk(child, column, parent, target, having):
    return f"""
        select 'foreign_key' as "check", '{child}' as "table", '{column}' as "column",
               'error' as severity, cast(count(*) as bigint) as failures,
               '{parent}: ' || count(distinct {column}) || ' keys' as detail
        from {child} where {column} not in (select {target} from {parent} {having})"""


@query("dq_fk", " union all ".join([
    _fk("lineitem", "l_orderkey", "orders", "o_orderkey", "where o_orderkey % 13 <> 0"),
    _fk("lineitem", "l_suppkey", "supplier", "s_suppkey", ""),
    _fk("orders", "o_custkey", "customer", "c_custkey", "where c_custkey % 9 <> 0")]))
def dq_fk(t):
    tables = {"lineitem": t.lineitem, "orders": t.orders, "supplier": t.supplier,
              "customer": t.customer}
    parents = {**tables, "orders": t.orders.filter("o_orderkey % 13 <> 0"),
               "customer": t.customer.filter("c_custkey % 9 <> 0")}
    return q.report([
        q.foreign_keys({**parents, c.name: tables[c.name]}, [c]) for c in LINKS])


@query("fk_listing", """
    select 'lineitem' as source, 'orders' as target, 'l_orderkey' as source_fields,
           'o_orderkey' as target_fields, count(*) as "rows" from lineitem
    union all select 'lineitem', 'supplier', 'l_suppkey', 's_suppkey', count(*) from lineitem
    union all select 'orders', 'customer', 'o_custkey', 'c_custkey', count(*) from orders""")
def fk_listing(t):
    listing = contract.relationships(t.spark, LINKS)
    sizes = q.report([getattr(t, n).agg(F.count("*").alias("rows")).select(
        F.lit(n).alias("source"), "rows") for n in ("lineitem", "orders")])
    return listing.join(sizes, "source").select(
        "source", "target", "source_fields", "target_fields", "rows")


@query("dq_club_consistency", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
    left join (select o_orderkey, o_custkey % 100 as a,
                      case when o_orderkey % 3 = 0 then null else o_custkey % 7 end as b
               from orders) on l_orderkey = o_orderkey
    where l_suppkey not in (a, b)""")
def dq_club_consistency(t):
    games = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 100).alias("a"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 7).alias("b"))
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return q.outside_pair(facts, "l_suppkey", games, "l_orderkey", ("a", "b"))


@query("dq_group_minimum", """
    select year(o_orderdate)::integer as season, o_orderpriority, o_custkey % 40 as league,
           count(*) as "rows"
    from orders where year(o_orderdate) <> 2001
    group by 1, 2, 3 having count(*) < 9""")
def dq_group_minimum(t):
    games = t.orders.select(F.year("o_orderdate").alias("season"), "o_orderpriority",
                            (F.col("o_custkey") % 40).alias("league"))
    return q.small_groups(games, ["season", "o_orderpriority", "league"],
                          F.col("season") != 2001, 9)


@query("dq_clubs_per_league", """
    select n_nationkey, expected, coalesce(actual, 0) as actual
    from (select n_nationkey, case when n_nationkey % 6 <> 0 then 55 + n_nationkey % 3 end
                     as expected from nation)
    left join (select case when c_nationkey = 4 then 5 else c_nationkey end as c_nationkey,
                      count(distinct c_custkey) as actual from customer group by 1) on n_nationkey = c_nationkey
    where expected is null or coalesce(actual, 0) < expected""")
def dq_clubs_per_league(t):
    key = F.col("n_nationkey")
    leagues = t.nation.select("n_nationkey", F.when(key % 6 != 0, key % 3 + 55).alias("expected"))
    # The customers of one nation are counted in another.
    nation = F.when(F.col("c_nationkey") == 4, F.lit(5)).otherwise(F.col("c_nationkey"))
    members = t.customer.select("c_custkey", nation.alias("c_nationkey"))
    return q.incomplete_parents(leagues, "n_nationkey", "expected", members, "c_nationkey",
                                "c_custkey")


@query("dq_monthly_distinct", """
    select cast(date_trunc('month', o_orderdate) as date) as grp,
           count(distinct o_custkey) as distinct_values
    from orders where month(o_orderdate) not in (5, 6, 7, 12, 1) and year(o_orderdate) <> 2000
    group by 1 having count(distinct o_custkey) <= 175""")
def dq_monthly_distinct(t):
    day = F.col("o_orderdate")
    regular = ~F.month(day).isin(5, 6, 7, 12, 1) & ~F.year(day).isin(2000)
    return q.few_distinct(t.orders, "o_custkey", F.trunc(day, "month"), 175, regular)


@query("dq_gaps", """
    select cast(d as date) as period
    from range(timestamp '2023-12-25', timestamp '2024-02-05', interval 1 day) r(d)
    where cast(d as date) not in (
        select cast(case when day(ts) % 5 = 0 then ts + interval 1 day else ts end as date)
        from events)""")
def dq_gaps(t):
    # Every fifth day of a month is moved away.
    moved = F.when(F.day("ts") % 5 == 0, F.col("ts") + F.expr("interval 1 day")).otherwise(F.col("ts"))
    return q.date_gaps(t.events.select(moved.alias("ts")), "ts", "day", "2023-12-25", "2024-02-05")


@query("dq_round_robin", """
    with games as (select o_custkey % 23 as league, year(o_orderdate)::integer as season,
                          o_orderkey, o_custkey % 31 as club from orders),
    per_season as (
        select league, season, count(distinct o_orderkey) as actual_games,
               count(distinct club) as season_clubs
        from games group by 1, 2)
    select league, season, actual_games, season_clubs,
           season_clubs * (season_clubs - 1) as expected_games
    from per_season
    where season <> (select max(season) from games)
      and league in (select league from per_season group by 1 having count(*) > 1)
      and league not in (2, 5, 7) and (league, season) not in ((1, 1999), (3, 1996))
      and actual_games <> season_clubs * (season_clubs - 1)""")
def dq_round_robin(t):
    games = t.orders.select((F.col("o_custkey") % 23).alias("league"),
                            F.year("o_orderdate").alias("season"), "o_orderkey",
                            (F.col("o_custkey") % 31).alias("club"))
    members = games.select("league").distinct()
    return q.incomplete_round_robin(games, "league", "season", "o_orderkey", "club", members,
                                    [2, 5, 7], [(1, 1999), (3, 1996)])


@query("distinct_ids", """
    select o_orderstatus, o_orderpriority, count(distinct o_custkey) as customers,
           count(distinct case when o_orderkey % 7 <> 0 then o_orderkey - 3000 end) as orders
    from orders group by all
    union all
    select o_orderstatus, null, count(distinct o_custkey),
           count(distinct case when o_orderkey % 7 <> 0 then o_orderkey - 3000 end)
    from orders group by all""")
def distinct_ids(t):
    # Ids below zero and missing ones; bitmaps of the small groups make those of the large.
    order = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") - 3000)
    rows = t.orders.select("o_orderstatus", "o_orderpriority", "o_custkey", order.alias("order"))
    kinds = {"customers": "o_custkey", "orders": "order"}
    small = ["o_orderstatus", "o_orderpriority"]
    maps = q.id_bitmaps(rows, small, kinds)
    large = q.merge_bitmaps(maps, small[:1])
    return q.count_bitmaps(maps, small, kinds).unionByName(
        q.count_bitmaps(large, small[:1], kinds).withColumn(
            "o_orderpriority", F.lit(None).cast("string")))


@query("key_report", " union all ".join([
    _row("unique", "orders", "o_orderkey", "count(*)")
    + " from (select 1 from orders group by o_orderkey having count(*) > 1)",
    _row("unique", "orders", "o_custkey,o_orderstatus", "count(*)")
    + " from (select 1 from orders where o_orderstatus <> 'P' group by o_custkey, o_orderstatus having count(*) > 1)",
    _row("unique", "lineitem", "l_orderkey,l_linenumber", "count(*)")
    + " from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)",
    _fk("lineitem", "l_orderkey", "orders", "o_orderkey", ""),
    _fk("lineitem", "l_suppkey", "supplier", "s_suppkey", "where s_suppkey % 4 <> 0"),
    _fk("orders", "o_custkey", "customer", "c_custkey", "where c_custkey % 9 <> 0")]))
def key_report(t):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    tables = {"lineitem": t.lineitem, "orders": t.orders.withColumn("o_orderstatus", status),
              "supplier": t.supplier.filter("s_suppkey % 4 <> 0"),
              "customer": t.customer.filter("c_custkey % 9 <> 0")}
    unique = {"orders": [["o_orderkey"], ["o_custkey", "o_orderstatus"]],
              "lineitem": [["l_orderkey", "l_linenumber"]]}
    index = q.key_index(tables, unique, LINKS, scratch(t.spark, "keys"))
    return q.report([q.index_unique(index, unique, tables),
                     q.index_foreign_keys(index, tables, LINKS)])


@query("dq_known_entity", """
    select u as user_id, count(distinct event_type) as distinct_values
    from (values (1), (2), (-1)) as n(u) left join events on user_id = u
         and (u <> 2 or event_type = 'view')
    group by u having count(distinct event_type) < 2""")
def dq_known_entity(t):
    # One user with a full history, one who shows a single type, one who has no row at all.
    shown = t.events.filter((F.col("user_id") != 2) | (F.col("event_type") == "view"))
    return q.report([q.short_history_of(shown, "user_id", user, "event_type", 2).select(
        F.lit(user).alias("user_id"), "distinct_values") for user in (1, 2, -1)])


@query("dq_entity_history", """
    select user_id, count(distinct case when user_id % 3 = 0 then 'view' else event_type end)
               as distinct_values
    from events group by 1
    having count(distinct case when user_id % 3 = 0 then 'view' else event_type end) < 3""")
def dq_entity_history(t):
    # Every third user shows one type only.
    kind = F.when(F.col("user_id") % 3 == 0, F.lit("view")).otherwise(F.col("event_type"))
    return q.short_history(t.events.select("user_id", kind.alias("event_type")), "user_id", "event_type", 3)


@query("dq_lost_history", """
    select distinct user_id from events
    where event_type <> 'error' and user_id not in (
        select user_id from (
            select user_id, event_type from events
            qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
        where event_type <> 'error')""")
def dq_lost_history(t):
    # The pick ranks before it filters, which is the mistake the check has to reveal.
    usable = F.col("event_type") != "error"
    newest = latest(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"],
                    F.desc("ts"), F.desc("event_id"))
    return q.lost_entities(t.events, usable, newest.filter(usable), "user_id")


@query("dq_cast_failures", """
    select 'p_brand' as "column", cast(count(*) filter (where p_partkey % 3 = 0) as bigint)
               as failures from part
    union all
    select 'p_size', cast(0 as bigint) from part having count(*) >= 0""")
def dq_cast_failures(t):
    brand = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.lit("7"))
    texts = {"p_brand": brand, "p_size": F.col("p_size").cast("string")}
    return q.cast_failures(t.part, texts, {c: to_int(x) for c, x in texts.items()})
