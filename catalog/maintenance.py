"""Merge, overlay, supplement, gate and contract."""

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from catalog import query
from pitchlake.operators import analyst, contract, gate, merge
from pitchlake.operators.quality import null_shares, report
from pitchlake.plans import refresh
from pitchlake.session import scratch
from pitchlake.sinks import writers
from pitchlake.sinks.releases import Releases


@query("upsert_merge", """
    select c_custkey, case when c_custkey % 3 <> 0 then upper(c_name) else c_name end as c_name,
           case when c_custkey % 3 <> 0 then null else c_acctbal end as c_acctbal,
           case when c_custkey % 3 <> 0 then c_custkey % 10 end as grade
    from customer""")
def upsert_merge(t):
    # Old: keys not 1 modulo 3. New: keys not 0 modulo 3, another column, one column fewer.
    key = F.col("c_custkey")
    old = t.customer.filter(key % 3 != 1).select("c_custkey", "c_name", "c_acctbal")
    new = t.customer.filter(key % 3 != 0).select(
        "c_custkey", F.upper("c_name").alias("c_name"), (key % 10).alias("grade"))
    return merge.upsert(new, old, ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal", "grade")


@query("merge_composite", """
    select key, max(case when prio = 1 then amount end) as new_amount,
           coalesce(max(case when prio = 1 then amount end), max(case when prio = 0 then amount end))
               as amount
    from (
        select o_custkey || '|' || o_orderstatus || '|' || o_orderpriority || '|'
                   || strftime(o_orderdate, '%Y-%m-%d') as key,
               1 as prio, min(o_totalprice) as amount
        from orders where o_orderkey % 2 = 0 group by 1
        union all
        select o_custkey || '|' || o_orderstatus || '|' || o_orderpriority || '|'
                   || strftime(o_orderdate, '%Y-%m-%d'), 0, min(o_totalprice)
        from orders where o_orderkey % 4 <> 0 group by 1)
    group by key""")
def merge_composite(t):
    records = t.orders.select(
        "o_orderkey", F.struct(F.col("o_custkey").cast("string").alias("href")).alias("parent"),
        F.col("o_orderstatus").alias("competition_code"),
        F.col("o_orderpriority").alias("matchday"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_totalprice")
    groups = ["parent", "competition_code", "matchday", "date"]

    def snapshot(condition):
        return records.filter(condition).groupBy(*groups).agg(F.min("o_totalprice").alias("amount"))

    new = snapshot(F.col("o_orderkey") % 2 == 0).withColumn("new_amount", F.col("amount"))
    old = snapshot(F.col("o_orderkey") % 4 != 0)
    merged = merge.merge_asset(new, old, asset="appearances")
    return merged.select(merge.record_key(merged, "appearances").alias("key"), "new_amount", "amount")


@query("retry_overlay", """
    select o_orderkey,
           case when o_orderkey % 3 <> 0 then o_orderpriority
                when o_orderkey % 6 = 0 then 'retried ' || o_orderstatus end as response
    from orders""")
def retry_overlay(t):
    key = F.col("o_orderkey")
    first = t.orders.select("o_orderkey", F.when(key % 3 != 0, F.col("o_orderpriority")).alias("response"))
    failed = first.filter(F.col("response").isNull()).select("o_orderkey")
    again = merge.within(t.orders, failed, "o_orderkey", "o_orderkey").select(
        "o_orderkey", F.when(key % 6 == 0, F.concat(F.lit("retried "), "o_orderstatus")).alias("response"))
    # Every answer comes twice, once more without text and once without a key.
    empty = again.withColumn("response", F.lit(None).cast("string"))
    lost = again.withColumn("o_orderkey", F.lit(None).cast(first.schema["o_orderkey"].dataType))
    answers = again.unionByName(again).unionByName(empty).unionByName(lost)
    return merge.retry_overlay(first, answers, "o_orderkey", "response")


@query("allowlist_supplement", """
    select c_custkey, c_mktsegment, case when c_custkey % 2 = 0 then 'found' else 'supplement' end
               as origin
    from customer where c_mktsegment in ('MACHINERY', 'FURNITURE')
      and (c_custkey % 2 = 0 or c_custkey % 3 = 0)""")
def allowlist_supplement(t):
    # Allowed are whole segments; the supplement overlaps what was found.
    rows = t.customer.select("c_custkey", "c_mktsegment")
    found = rows.filter("c_custkey % 2 = 0").withColumn("origin", F.lit("found"))
    extra = rows.filter("c_custkey % 3 = 0").withColumn("origin", F.lit("supplement"))
    allowed = F.col("c_mktsegment").isin("MACHINERY", "FURNITURE")
    return merge.supplement(found, extra, "c_custkey", allowed, [F.asc("origin")])


@query("write_gate", """
    select count(*) as total, count(*) filter (where event_type = 'error') as nulls,
           count(*) filter (where event_type = 'error') / count(*) as null_share,
           count(*) filter (where event_type = 'error') / count(*) <= 0.2 as accepted
    from events""")
def write_gate(t):
    return gate.gate_verdict(t.events, F.col("event_type") == "error")


@query("write_gate_by_day", """
    select cast(ts as date) as day, count(*) as total,
           count(*) filter (where event_type = 'error') as nulls,
           round(100.0 * count(*) filter (where event_type = 'error') / count(*), 1)::double as null_pct
    from events group by 1
    having count(*) filter (where event_type = 'error') > 0.2 * count(*)""")
def write_gate_by_day(t):
    days = null_shares(t.events.select(F.to_date("ts").alias("day"), "event_type"), "day",
                       F.col("event_type") == "error")
    return (days.filter(F.col("null_count") > gate.MAX_NULL_SHARE * F.col("total"))
            .withColumnRenamed("null_count", "nulls"))


PART = contract.Contract("part", tuple(
    contract.Field(n, k, tags=("explore",) if n in ("p_brand", "p_type") else ())
    for n, k in (("p_partkey", "integer"), ("p_brand", "string"), ("p_name", "string"),
                 ("p_size", "integer"), ("p_type", "string"), ("p_retailprice", "number"))))


@query("contract_project",
       "select p_partkey, p_brand, p_name, p_size, p_type, p_retailprice from part")
def contract_project(t):
    return PART.project(t.part)


@query("tagged_options", """
    select p_brand, p_type, count(*) as "rows" from part group by p_brand, p_type""")
def tagged_options(t):
    columns = analyst.default_filters(t.part, PART.tagged("explore"))
    return t.part.groupBy(*columns).agg(F.count("*").alias("rows"))


@query("scope_chain", """
    select 'clubs' as asset, '/x/' || n_nationkey || '/' as href from nation where n_regionkey in (1, 3)
    union all
    select 'players', '/x/' || c_custkey || '/' from customer join nation on c_nationkey = n_nationkey
    where n_regionkey in (1, 3)
    union all
    select 'appearances', '/x/' || o_orderkey || '/' from orders join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey where n_regionkey in (1, 3)
    union all
    select 'games', '/x/' || o_orderkey || '/' from orders where o_orderkey % 5 in (1, 3)
    union all
    select 'game_lineups', '/x/' || o_orderkey || '/' from orders where o_orderkey % 5 in (1, 3)""")
def scope_chain(t):
    # Regions stand for competitions, nations for clubs, customers for players.
    def href(id_, parent=None):
        fields = [F.concat(F.lit("/x/"), id_.cast("string"), F.lit("/")).alias("href")]
        owner = parent if parent is not None else F.lit(0)
        return fields + [F.struct(F.concat(F.lit("/y/"), owner.cast("string")).alias("href"))
                         .alias("parent")]

    order = F.col("o_orderkey")
    kept = merge.scope_chain({
        "competitions": t.region.select(*href(F.col("r_regionkey"))),
        "clubs": t.nation.select(*href(F.col("n_nationkey"), F.col("n_regionkey"))),
        "players": t.customer.select(*href(F.col("c_custkey"), F.col("c_nationkey"))),
        "appearances": t.orders.select(*href(order, F.col("o_custkey"))),
        "games": t.orders.select(*href(order, order % 5)),
        "game_lineups": t.orders.select(*href(order)),
    }, competitions=["1", "3"])
    return report([df.select(F.lit(asset).alias("asset"), "href")
                   for asset, df in kept.items() if asset != "competitions"])


WORLD = [
    contract.Contract("supplier", (), (), (
        contract.ForeignKey(("s_nationkey",), "nation", ("n_nationkey",)),)),
    contract.Contract("customer", (), (), (
        contract.ForeignKey(("c_nationkey",), "nation", ("n_nationkey",)),)),
    contract.Contract("orders", (), (), (
        contract.ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)),
    contract.Contract("lineitem", (), (), (
        contract.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        contract.ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)))),
]
WORLD_KEYS = {"region": ("r_regionkey",), "nation": ("n_nationkey",), "supplier": ("s_suppkey",),
              "customer": ("c_custkey",), "orders": ("o_orderkey",),
              "lineitem": ("l_orderkey", "l_linenumber")}


@query("scope_closure", """
    with n as (select n_nationkey from nation where n_nationkey in (3, 7)),
    s as (select s_suppkey from supplier where s_nationkey in (select * from n)),
    c as (select c_custkey from customer where c_nationkey in (select * from n)),
    o as (select o_orderkey from orders where o_custkey in (select * from c))
    select 'region' as "table", r_regionkey::varchar as id from region
    union all select 'nation', n_nationkey::varchar from n
    union all select 'supplier', s_suppkey::varchar from s
    union all select 'customer', c_custkey::varchar from c
    union all select 'orders', o_orderkey::varchar from o
    union all select 'lineitem', l_orderkey || ' ' || l_linenumber from lineitem
    where l_orderkey in (select * from o) or l_suppkey in (select * from s)""")
def scope_closure(t):
    # Lines are reached over orders and over suppliers; regions are reached over nothing.
    tables = {name: getattr(t, name) for name in WORLD_KEYS}
    wanted = t.nation.select("n_nationkey").filter("n_nationkey in (3, 7)")
    kept = merge.scope_closure(tables, WORLD, {"nation": wanted})
    return report([kept[name].select(F.lit(name).alias("table"),
                                     F.concat_ws(" ", *keys).alias("id"))
                   for name, keys in WORLD_KEYS.items()])


@query("merge_snapshot_files", """
    select '/p/' || c_custkey as href, case when c_custkey % 3 <> 0 then 'new' else 'old' end as code,
           case when c_custkey % 3 <> 0 then cast(c_nationkey as varchar) end
               as current_market_value,
           '/c/' || c_nationkey as club, case when c_custkey % 3 <> 0 then c_mktsegment end as coach
    from customer""")
def merge_snapshot_files(t):
    # In old files the value is always null and the parent has fewer fields.
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    club = F.concat(F.lit("/c/"), nation).alias("href")
    href = F.concat(F.lit("/p/"), key.cast("string")).alias("href")
    old = t.customer.filter(key % 3 != 1).select(
        href, F.lit("old").alias("code"), F.struct(club).alias("parent"))
    new = t.customer.filter(key % 3 != 0).select(
        href, F.lit("new").alias("code"), F.col("c_nationkey").alias("current_market_value"),
        F.struct(club, F.col("c_mktsegment").alias("coach")).alias("parent"))
    paths = [writers.export_json(df, scratch(t.spark, "players.json")) for df in (new, old)]
    merged = refresh.merge_snapshot(t.spark, paths[0], paths[1], "players",
                                    scratch(t.spark, "merged.json"))
    return t.spark.read.json(merged).select(
        "href", "code", "current_market_value",
        F.get_json_object("parent", "$.href").alias("club"),
        F.get_json_object("parent", "$.coach").alias("coach"))


@query("merge_drift", """
    select '/p/' || c_custkey as href,
           case when c_custkey % 3 <> 0 then '1,' || c_nationkey || ' m' else c_custkey::varchar end as height,
           case when c_custkey % 3 <> 0 then '/c/' || c_nationkey
                else '{"href":"/c/' || c_nationkey || '"}' end as parent,
           case when c_custkey % 3 <> 0 then c_mktsegment else '["' || c_mktsegment || '"]' end as tags,
           case when c_custkey % 3 <> 0 then c_nationkey + 0.5::double else c_nationkey end as size,
           case when c_custkey % 3 <> 0 then c_custkey::varchar else c_name end as "inner"
    from customer""")
def merge_drift(t):
    # Old: number, object, list, whole number, text in an object. New: text, text, text, fraction, number.
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    href = F.concat(F.lit("/p/"), key.cast("string")).alias("href")
    club = F.concat(F.lit("/c/"), nation)
    old = t.customer.filter(key % 3 != 1).select(
        href, key.alias("height"), F.struct(club.alias("href")).alias("parent"),
        F.array("c_mktsegment").alias("tags"), F.col("c_nationkey").alias("size"),
        F.struct(F.col("c_name").alias("x")).alias("inner"))
    new = t.customer.filter(key % 3 != 0).select(
        href, F.concat(F.lit("1,"), nation, F.lit(" m")).alias("height"), club.alias("parent"),
        F.col("c_mktsegment").alias("tags"), (F.col("c_nationkey") + F.lit(0.5)).alias("size"),
        F.struct(key.alias("x")).alias("inner"))
    paths = [writers.export_json(df, scratch(t.spark, "countries.json")) for df in (new, old)]
    merged = refresh.merge_snapshot(t.spark, paths[0], paths[1], "countries",
                                    scratch(t.spark, "merged.json"))
    schema = "href string, height string, parent string, tags string, size double, inner struct<x: string>"
    return t.spark.read.schema(schema).json(merged).withColumn("inner", F.col("inner.x"))


@query("guarded_overwrite", """
    select 'market_values.json' as output, c_custkey as player_id, c_mktsegment as response, 3 as refused
    from customer
    union all
    select 'transfers.json', c_custkey, c_name, 3 from customer where c_custkey % 5 <> 0""")
def guarded_overwrite(t):
    # Good data, then an empty set, one with a quarter missing, and one that fails half-way.
    key = F.col("c_custkey").alias("player_id")
    wanted = t.customer.filter("c_custkey % 5 <> 0").select(key)
    values = t.customer.select(key, F.col("c_mktsegment").alias("response"))
    moves = t.customer.select(key, F.col("c_name").alias("response"))
    store = Releases(t.spark, scratch(t.spark, "responses"))
    refresh.store_responses(values, moves, wanted, store)
    poor = values.withColumn("response", F.when(F.col("player_id") % 4 != 0, F.lit("poor")))
    broken = moves.withColumn("response", F.coalesce(
        F.when(F.col("player_id") >= 0, F.raise_error(F.lit("connection lost"))), F.lit("")))
    refused = 0
    for first, second in ((values.limit(0), moves), (poor, moves),
                          (values.withColumn("response", F.lit("new")), broken)):
        try:
            refresh.store_responses(first, second, wanted, store)
        except (gate.RefusedWrite, SparkRuntimeException):
            refused += 1
    schema = "player_id long, response string"
    return report([t.spark.read.schema(schema).json(path).select(
        F.lit(name).alias("output"), "player_id", "response", F.lit(refused).alias("refused"))
        for name, path in store.current().items()])


@query("supplement_competitions", """
    select '/x/wettbewerb/P' || p_partkey as href,
           case when p_partkey % 2 = 0 then p_size::varchar else 'hand ' || p_brand end as total_clubs,
           p_partkey % 2 = 0 as found
    from part where p_partkey % 5 = 0 and (p_partkey % 2 = 0 or p_partkey % 3 = 0)""")
def supplement_competitions(t):
    # Even ones are found, with a number; multiples of three are written by hand, with text.
    key = F.col("p_partkey")
    href = F.concat(F.lit("/x/wettbewerb/P"), key.cast("string")).alias("href")
    found = t.part.filter(key % 2 == 0).select(
        href, F.col("p_size").alias("total_clubs"), F.lit(True).alias("found"))
    extra = t.part.filter(key % 3 == 0).select(
        href, F.concat(F.lit("hand "), "p_brand").alias("total_clubs"), F.lit(False).alias("found"))
    paths = [writers.export_json(df, scratch(t.spark, "competitions.json")) for df in (found, extra)]
    newest = t.part.agg(F.max("p_partkey")).first()[0]
    allowed = t.spark.range(0, newest + 1, 5).select(F.concat(F.lit("P"), F.col("id").cast("string")))
    merged = refresh.supplement_competitions(t.spark, *paths, allowed, scratch(t.spark, "merged.json"))
    return t.spark.read.schema("href string, total_clubs string, found boolean").json(merged)
