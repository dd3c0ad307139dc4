"""Picks per key, reshaping and order."""

from pyspark.sql import functions as F

from catalog import query
from pitchlake.operators import analyst, reshape, snapshot
from pitchlake.sinks.writers import in_order

EVENT = "event_id, ts, user_id, event_type, value, props"
LINE = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
        "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@query("latest_snapshot", f"""
    select {EVENT} from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def latest_snapshot(t):
    return snapshot.latest(t.events, ["user_id"], F.desc("ts"), F.desc("event_id"))


@query("filter_before_rank", f"""
    select {EVENT} from events where event_type <> 'error'
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def filter_before_rank(t):
    usable = t.events.filter(F.col("event_type") != "error")
    return snapshot.latest(usable, ["user_id"], F.desc("ts"), F.desc("event_id"))


@query("any_one_per_key", "select p_brand, min(p_name) as p_name from part group by p_brand")
def any_one_per_key(t):
    return snapshot.any_value_per_key(t.part, "p_brand", "p_name")


@query("one_per_day", """
    select user_id, cast(ts as date) as day, event_id, event_type, value from events
    qualify row_number() over (
        partition by user_id, cast(ts as date) order by ts desc, event_id desc) = 1""")
def one_per_day(t):
    daily = t.events.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id",
                            "event_type", "value")
    return snapshot.latest(daily, ["user_id", "day"], F.desc("ts"), F.desc("event_id")).drop("ts")


@query("composite_dedup", f"""
    select {LINE} from lineitem
    qualify row_number() over (
        partition by l_partkey, l_suppkey, l_returnflag
        order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_quantity desc,
                 l_extendedprice desc, l_discount desc, l_tax desc, l_linestatus desc) = 1""")
def composite_dedup(t):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_linestatus"]
    return snapshot.latest(t.lineitem, ["l_partkey", "l_suppkey", "l_returnflag"],
                           *[F.desc(c) for c in order])


@query("distinct_rows", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query("current_and_peak", """
    with ranked as (
        select *, row_number() over (
            partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n
        from orders)
    select o_custkey, max(case when n = 1 then o_totalprice end) as current_price,
           max(o_totalprice) as peak_price
    from ranked group by o_custkey""")
def current_and_peak(t):
    return snapshot.current_and_peak(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"],
                                     "o_totalprice", "current_price", "peak_price")


@query("two_sided", """
    select l_orderkey, o_custkey as party, l_suppkey as counterparty, l_quantity as own_measure,
           l_extendedprice as other_measure, 'Buyer' as side,
           case when l_quantity > l_extendedprice then 1 else 0 end as ahead
    from lineitem join orders on l_orderkey = o_orderkey
    union all
    select l_orderkey, l_suppkey, o_custkey, l_extendedprice, l_quantity, 'Seller',
           case when l_extendedprice > l_quantity then 1 else 0 end
    from lineitem join orders on l_orderkey = o_orderkey""")
def two_sided(t):
    deals = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    both = reshape.two_sided(
        deals, ["l_orderkey"],
        {"id": ("o_custkey", "l_suppkey"), "measure": ("l_quantity", "l_extendedprice")},
        {"id": ("party", "counterparty"), "measure": ("own_measure", "other_measure")},
        "side", ("Buyer", "Seller"))
    ahead = F.coalesce((F.col("own_measure") > F.col("other_measure")).cast("int"), F.lit(0))
    return both.withColumn("ahead", ahead)


@query("four_way_unpivot", """
    with legs as (
        select l_orderkey, 'quantity' as leg, cast(l_quantity as bigint) as amount from lineitem
        union
        select l_orderkey, 'line', cast(l_linenumber as bigint) from lineitem
        union
        select l_orderkey, 'part', l_partkey from lineitem
        union
        select l_orderkey, 'supplier', l_suppkey from lineitem)
    select * from legs""")
def four_way_unpivot(t):
    legs = [{"leg": F.lit(name), "amount": F.col(column).cast("long")}
            for name, column in (("quantity", "l_quantity"), ("line", "l_linenumber"),
                                 ("part", "l_partkey"), ("supplier", "l_suppkey"))]
    return reshape.sides(t.lineitem, legs, ["l_orderkey"]).dropDuplicates()


@query("json_fields", """
    select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
           json_extract_string(props, '$.absent.deeper') as absent
    from events""")
def json_fields(t):
    parsed = F.from_json("props", "k string, absent struct<deeper: string>")
    return t.events.select("event_id", parsed.alias("j")).select(
        "event_id", F.col("j.k").try_cast("int").alias("k"), F.col("j.absent.deeper").alias("absent"))


@query("json_explode", """
    select event_id % 97 as bucket, count(*) as pieces,
           cast(sum(cast(json_extract_string(props, '$.k') as bigint) + i) as bigint) as total
    from events, (values (0), (1), (2)) as copies(i)
    where i <= event_id % 3
    group by 1""")
def json_explode(t):
    # A list of one to three objects per row, as text; the SQL adds up the same numbers.
    k = F.get_json_object("props", "$.k").cast("long")
    items = F.to_json(F.transform(F.sequence(F.lit(0), F.col("event_id") % 3),
                                  lambda i: F.struct((k + i).alias("k"))))
    lists = t.events.select((F.col("event_id") % 97).alias("bucket"), items.alias("list"))
    pieces = reshape.explode_json(lists, F.col("list"), "item")
    value = F.get_json_object("item", "$.k").cast("long")
    return pieces.groupBy("bucket").agg(F.count("*").alias("pieces"), F.sum(value).alias("total"))


@query("nested_distinct", """
    select distinct event_id,
           case i when 3 then event_type else cast(event_id % i as varchar) end as item
    from events, (values (1), (2), (3), (4)) as copies(i)""")
def nested_distinct(t):
    number = F.col("event_id")
    items = F.array((number % 1).cast("string"), (number % 2).cast("string"),
                    F.col("event_type"), (number % 4).cast("string"))
    return reshape.explode_distinct(t.events.select("event_id", "event_type"), items,
                                    "item").drop("event_type")


@query("topk", """
    select c_custkey, c_name, c_mktsegment, c_acctbal from customer
    where c_mktsegment = 'MACHINERY'
    order by c_acctbal desc, c_custkey limit 10""")
def topk(t):
    segment = t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return analyst.top(segment, 10, F.desc("c_acctbal"), F.asc("c_custkey"))


@query("preview_filter", """
    select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part
    where p_type = 'ECONOMY' and p_name = 'red widget' order by p_partkey limit 20""")
def preview_filter(t):
    return analyst.preview(t.part, {"p_type": "ECONOMY", "p_name": "red widget"},
                           [F.asc("p_partkey")])


@query("total_order", """
    select event_id, user_id, event_type,
           case when event_type = 'error' then null else value end as value
    from events order by value asc nulls last, user_id desc nulls last, event_id""")
def total_order(t):
    known = F.when(F.col("event_type") != "error", F.col("value"))
    rows = t.events.select("event_id", "user_id", "event_type", known.alias("value"))
    return in_order(rows, "value", "user_id desc", "event_id")


@query("nulls_last_head", """
    select event_id, user_id, case when event_type = 'error' then null else event_type end as kind
    from events order by kind asc nulls last, event_id limit 20""")
def nulls_last_head(t):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = t.events.select("event_id", "user_id", kind.alias("kind"))
    return in_order(rows, "kind", "event_id").limit(20)
