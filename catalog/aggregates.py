"""Grouped and global aggregates, profiles and deltas."""

from pyspark.sql import functions as F

from catalog import query
from pitchlake.operators import analyst, quality


@query("having_counts", """
    select year(o_orderdate)::integer as season, o_orderstatus, o_orderpriority,
           count(*) as n_orders, count(distinct o_custkey) as customers,
           count(distinct o_orderdate) as days,
           count(distinct o_custkey) * (count(distinct o_custkey) - 1) as expected
    from orders group by 1, 2, 3 having count(distinct o_custkey) > 100""")
def having_counts(t):
    customers = F.countDistinct("o_custkey")
    return (t.orders.groupBy(F.year("o_orderdate").alias("season"), "o_orderstatus",
                             "o_orderpriority")
            .agg(F.count("*").alias("n_orders"), customers.alias("customers"),
                 F.countDistinct("o_orderdate").alias("days"),
                 (customers * (customers - 1)).alias("expected"))
            .filter("customers > 100"))


@query("filtered_share", """
    select cast(ts as date) as day, count(*) as total,
           count(*) filter (where event_type = 'error') as null_count,
           round(100.0 * count(*) filter (where event_type = 'error') / count(*), 1)::double
               as null_pct
    from events group by 1""")
def filtered_share(t):
    days = t.events.select(F.to_date("ts").alias("day"), "event_type")
    return quality.null_shares(days, "day", F.col("event_type") == "error")


@query("global_check", """
    select count(*) as total, count(*) - count(nullif(event_type, 'error')) as missings,
           round((count(*) - count(nullif(event_type, 'error'))) / count(*), 6)::double as missings_pct,
           (select count(*) from nation having count(*) between 20 and 30) as nations
    from events""")
def global_check(t):
    known = F.count(F.nullif("event_type", F.lit("error")))
    nations = t.nation.agg(F.count("*").alias("n")).filter(F.col("n").between(20, 30)).scalar()
    return t.events.agg(
        F.count("*").alias("total"), (F.count("*") - known).alias("missings"),
        F.round((F.count("*") - known) / F.count("*"), 6).alias("missings_pct")).withColumn(
            "nations", nations)


@query("records_delta", """
    select count(*) as records,
           count(*) filter (where ts > date '2024-01-20' - interval 7 day) as delta
    from events""")
def records_delta(t):
    return analyst.records_delta(t.events, F.lit("2024-01-20").cast("date"), "ts", 7)


def _profile_sql(table, columns):
    """Three smallest distinct values of every column."""
    return " union all ".join(f"""
        select '{name}' as field, '{kind}' as type, cast(null as varchar) as description,
               array_to_string(list_transform(list_sort(list(distinct {name}))[1:3],
                                              lambda x: cast(x as varchar)), ', ') as sample_values
        from {table}""" for name, kind in columns)


@query("table_profile", _profile_sql("nation", [
    ("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]))
def table_profile(t):
    return analyst.profile(t.nation)


@query("table_profile_orders", _profile_sql("orders", [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_orderpriority", "string")]))
def table_profile_orders(t):
    return analyst.profile(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                                           "o_orderpriority"))


@query("table_diff", """
    with old as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
                 where o_orderkey % 10 <> 1),
    new as (select o_orderkey, o_custkey,
                   case when o_orderkey % 7 = 0 then null else o_orderstatus end as o_orderstatus,
                   case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end
                       as o_totalprice
            from orders where o_orderkey % 10 <> 2)
    select 'added' as kind, '*' as "column", count(*) as "rows" from new anti join old using (o_orderkey)
    union all
    select 'removed', '*', count(*) from old anti join new using (o_orderkey)
    union all
    select 'changed', 'o_orderstatus', count(*) from old join new using (o_orderkey)
    where old.o_orderstatus is distinct from new.o_orderstatus
    union all
    select 'changed', 'o_totalprice', count(*) from old join new using (o_orderkey)
    where old.o_totalprice is distinct from new.o_totalprice""")
def table_diff(t):
    key = F.col("o_orderkey")
    build = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    status = F.when(key % 7 != 0, F.col("o_orderstatus"))
    price = F.when(key % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = build.withColumns({"o_orderstatus": status, "o_totalprice": price})
    return analyst.table_diff(build.filter(key % 10 != 1), new.filter(key % 10 != 2),
                              ["o_orderkey"])


@query("table_diff_repeated_keys", """
    with old as (select case when o_orderkey % 3 <> 0 then o_custkey end as k, o_orderstatus,
                        o_orderpriority
                 from orders where o_orderkey % 10 <> 1),
    new as (select case when o_orderkey % 3 <> 0 then o_custkey end as k,
                   case when o_orderkey % 7 <> 0 then o_orderstatus end as o_orderstatus,
                   case when o_orderkey % 4 = 0 then '6-NONE' else o_orderpriority end
                       as o_orderpriority
            from orders where o_orderkey % 10 <> 2 and o_orderkey % 11 <> 2),
    a as (select *, row_number() over (partition by k order by o_orderstatus nulls first,
                                       o_orderpriority nulls first) as n
          from (from old except all from new)),
    b as (select *, row_number() over (partition by k order by o_orderstatus nulls first,
                                       o_orderpriority nulls first) as n
          from (from new except all from old)),
    pairs as (select a.n as i, b.n as j, a.o_orderstatus as s, b.o_orderstatus as t,
                     a.o_orderpriority as p, b.o_orderpriority as q
              from a full join b on a.k is not distinct from b.k and a.n = b.n),
    counts as (
        select 'added' as kind, '*' as "column", count(*) as "rows" from pairs where i is null
        union all
        select 'removed', '*', count(*) from pairs where j is null
        union all
        select 'changed', 'o_orderstatus', count(*) from pairs
        where i is not null and j is not null and s is distinct from t
        union all
        select 'changed', 'o_orderpriority', count(*) from pairs
        where i is not null and j is not null and p is distinct from q)
    from counts where "rows" > 0""")
def table_diff_repeated_keys(t):
    key = F.col("o_orderkey")
    build = t.orders.select("o_orderkey", F.when(key % 3 != 0, F.col("o_custkey")).alias("k"),
                            "o_orderstatus", "o_orderpriority")
    priority = F.when(key % 4 == 0, "6-NONE").otherwise(F.col("o_orderpriority"))
    new = build.withColumns({"o_orderstatus": F.when(key % 7 != 0, F.col("o_orderstatus")),
                             "o_orderpriority": priority})
    return analyst.table_diff(
        build.filter(key % 10 != 1).drop("o_orderkey"),
        new.filter((key % 10 != 2) & (key % 11 != 2)).drop("o_orderkey"), ["k"])


@query("table_diff_copies", """
    with old as (select o_orderstatus as k, o_orderpriority as p, year(o_orderdate) as y from orders),
    new as (select o_orderstatus as k,
                   case when o_orderkey % 3 = 0 then '6-NONE' else o_orderpriority end as p,
                   year(o_orderdate) as y
            from orders where o_orderkey % 4 <> 1),
    a as (select *, row_number() over (partition by k order by p, y) as n
          from (from old except all from new)),
    b as (select *, row_number() over (partition by k order by p, y) as n
          from (from new except all from old)),
    pairs as (select a.n as i, b.n as j, a.p as p, b.p as q, a.y as y, b.y as z
              from a full join b on a.k = b.k and a.n = b.n)
    select * from (
        select 'added' as kind, '*' as "column", count(*) as "rows" from pairs where i is null
        union all
        select 'removed', '*', count(*) from pairs where j is null
        union all
        select 'changed', 'p', count(*) from pairs where i is not null and j is not null and p <> q
        union all
        select 'changed', 'y', count(*) from pairs where i is not null and j is not null and y <> z)
    where "rows" > 0""")
def table_diff_copies(t):
    # Three keys with a few hundred different rows, each of them many times.
    key = F.col("o_orderkey")
    build = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("k"),
                            F.col("o_orderpriority").alias("p"), F.year("o_orderdate").alias("y"))
    new = build.withColumn("p", F.when(key % 3 == 0, "6-NONE").otherwise(F.col("p")))
    return analyst.table_diff(build.drop("o_orderkey"),
                              new.filter(key % 4 != 1).drop("o_orderkey"), ["k"])
