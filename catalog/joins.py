"""Lookups, as-of attribution, semi and anti joins."""

from pyspark.sql import functions as F

from catalog import query
from pitchlake.operators import merge
from pitchlake.operators.asof import DATE_GRAINS, TIMESTAMP_GRAINS, asof_join


@query("role_playing", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, cn.n_name as buyer_nation,
           coalesce(case when sn.n_nationkey % 5 <> 0 then sn.n_name end, s_name)
               as seller_nation
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey
    left join nation cn on cn.n_nationkey = c_nationkey
    left join nation sn on sn.n_nationkey = s_nationkey""")
def role_playing(t):
    nation = t.nation
    buyers = (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
              .join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey"))
    buyer = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                          F.col("n_name").alias("buyer_nation"))
    known = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name"))
    seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), known.alias("known"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return (lines.join(buyers, "l_orderkey").join(sellers, "l_suppkey")
            .join(buyer, "c_nationkey", "left").join(seller, "s_nationkey", "left")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "buyer_nation",
                    F.coalesce("known", "s_name").alias("seller_nation")))


@query("star_join", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           o.o_orderdate, c_name, r.o_totalprice as urgent_total
    from lineitem
    join orders o on l_orderkey = o.o_orderkey
    left join customer on o.o_custkey = c_custkey
    left join orders r on l_orderkey = r.o_orderkey and r.o_orderpriority = '1-URGENT'""")
def star_join(t):
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"),
        "o_orderdate", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))
        .alias("urgent_total"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                              "l_extendedprice")
    return (lines.join(orders, "l_orderkey")
            .join(t.customer.select("c_custkey", "c_name"), "c_custkey", "left")
            .drop("c_custkey"))


@query("residual_join", """
    select o_orderkey, o_custkey, l_partkey, l_quantity
    from orders left join lineitem
        on o_orderkey = l_orderkey and l_linenumber = 1 and l_returnflag = 'R'""")
def residual_join(t):
    # The right side is filtered first: the residual predicate reaches its scan.
    first = t.lineitem.filter((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R"))
    return t.orders.select("o_orderkey", "o_custkey").join(
        first.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity"),
        "o_orderkey", "left")


ASOF = """
    with looks as (select event_id, user_id, ts from events where event_type = 'view'),
    buys as (select event_id, user_id, ts, case when event_id % 4 = 0 then null else value end as value
             from events where event_type = 'purchase'),
    ranked as (
        select l.event_id, b.value, b.event_id as purchase_id,
               row_number() over (partition by l.event_id order by b.ts desc, b.event_id desc) as n
        from looks l join buys b on l.user_id = b.user_id and b.ts <= l.ts)
"""


@query("asof_join", ASOF + """
    select l.event_id, l.user_id, l.ts, r.purchase_id, r.value,
           coalesce(r.value, -1) as value_or_default
    from looks l left join ranked r on l.event_id = r.event_id and r.n = 1""")
def asof(t):
    looks = t.events.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    value = F.when(F.col("event_id") % 4 != 0, F.col("value"))
    buys = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought"),
        value.alias("value"))
    joined = asof_join(looks, buys, "user_id", "ts", "bought", ["purchase_id", "value"],
                       [F.col("purchase_id")], TIMESTAMP_GRAINS)
    return joined.withColumn("value_or_default", F.coalesce("value", F.lit(-1.0)))


@query("asof_hot_key", """
    with e as (select event_id, case when user_id % 10 = 0 then user_id else 1 end as owner,
                      date_trunc('minute', ts) as moment, event_type, value from events),
    looks as (select event_id, owner, moment from e where event_type = 'view'),
    buys as (select owner, moment, max(event_id) as purchase_id, arg_max(value, event_id) as value
             from e where event_type = 'purchase' group by 1, 2)
    select l.event_id, l.owner, l.moment, b.purchase_id, b.value
    from looks l asof left join buys b on l.owner = b.owner and l.moment >= b.moment""")
def asof_hot_key(t):
    # One user owns most events, and many of them share a minute.
    events = t.events.select(
        "event_id", F.when(F.col("user_id") % 10 == 0, F.col("user_id")).otherwise(F.lit(1)).alias("owner"),
        F.date_trunc("minute", "ts").alias("moment"), "event_type", "value")
    looks = events.filter(F.col("event_type") == "view").select("event_id", "owner", "moment")
    buys = events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "owner", F.col("moment").alias("bought"), "value")
    return asof_join(looks, buys, "owner", "moment", "bought", ["purchase_id", "value"],
                     [F.col("purchase_id")], TIMESTAMP_GRAINS)


@query("asof_by_date", """
    with states as (select o_custkey, cast(o_orderdate as date) as d, o_orderpriority, o_orderkey
                    from orders where o_orderstatus = 'F'),
    ranked as (
        select p.o_orderkey, s.o_orderpriority, row_number() over (
            partition by p.o_orderkey order by s.d desc, s.o_orderkey desc) as n
        from orders p join states s
          on p.o_custkey = s.o_custkey and s.d <= cast(p.o_orderdate as date))
    select p.o_orderkey, p.o_custkey, cast(p.o_orderdate as date) as day,
           r.o_orderpriority as last_priority
    from orders p left join ranked r on p.o_orderkey = r.o_orderkey and r.n = 1""")
def asof_by_date(t):
    points = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    states = t.orders.filter(F.col("o_orderstatus") == "F").select(
        "o_custkey", F.to_date("o_orderdate").alias("since"), F.col("o_orderkey").alias("of_order"),
        F.col("o_orderpriority").alias("last_priority"))
    return asof_join(points, states, "o_custkey", "day", "since", ["last_priority"],
                     [F.col("of_order")], DATE_GRAINS)


@query("semi_filter", """
    select o_orderkey, o_custkey, o_totalprice from orders
    where o_custkey in (
        select c_custkey from customer where c_nationkey in (
            select n_nationkey from nation where n_regionkey in (
                select r_regionkey from region where r_name in ('ASIA', 'EUROPE'))))""")
def semi_filter(t):
    regions = merge.only_ids(t.region, F.col("r_name"), ["ASIA", "EUROPE"], "region")
    nations = merge.within(t.nation, regions, "n_regionkey", "r_regionkey")
    customers = merge.within(t.customer, nations, "c_nationkey", "n_nationkey")
    return merge.within(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), customers,
                        "o_custkey", "c_custkey")


@query("anti_filter", """
    select c_custkey, c_name from customer
    where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P'
                            and o_custkey is not null)""")
def anti_filter(t):
    ordered = t.orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("c_custkey"))
    return merge.without(t.customer.select("c_custkey", "c_name"), ordered, ["c_custkey"])


@query("tuple_anti", """
    select o_orderkey, o_orderstatus, o_orderpriority from orders
    where (o_orderstatus, o_orderpriority) not in (
        values ('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH'))""")
def tuple_anti(t):
    skipped = t.spark.sql("""select * from values ('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH')
                             as pairs(o_orderstatus, o_orderpriority)""")
    return merge.without(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
                         skipped, ["o_orderstatus", "o_orderpriority"])


@query("scalar_subquery", """
    select o_orderkey, year(o_orderdate)::integer as season, o_totalprice from orders
    where year(o_orderdate) <> (select max(year(o_orderdate)) from orders)
      and (select count(distinct o_custkey) from orders) >= 2""")
def scalar_subquery(t):
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("season"),
                             "o_custkey", "o_totalprice")
    newest = orders.agg(F.max("season")).scalar()
    buyers = orders.agg(F.countDistinct("o_custkey")).scalar()
    return orders.filter((F.col("season") != newest) & (buyers >= 2)).drop("o_custkey")


@query("team_scorers", """
    select l_orderkey, l_linenumber, l_partkey, l_quantity, c_name, o_orderdate
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    where l_returnflag = 'R' and (c_mktsegment = 'MACHINERY' or o_orderpriority = '1-URGENT')
      and l_quantity > 10
    order by o_orderdate desc, l_orderkey, l_linenumber, l_partkey""")
def team_scorers(t):
    lines = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 10)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                             F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderpriority")
    side = (F.col("c_mktsegment") == "MACHINERY") | (F.col("o_orderpriority") == "1-URGENT")
    return (lines.join(orders, "l_orderkey").join(t.customer, "c_custkey").filter(side)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "c_name", "o_orderdate")
            .orderBy(F.desc("o_orderdate"), "l_orderkey", "l_linenumber", "l_partkey"))
