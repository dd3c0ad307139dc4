"""Scans and sinks: tables are written below the shared folder and read back."""

from pyspark.sql import functions as F, types as T

from catalog import query
from pitchlake.operators.quality import report
from pitchlake.session import scratch
from pitchlake.sinks import writers
from pitchlake.sinks.releases import Releases
from pitchlake.sources import snapshots


@query("lineage", """
    select c_custkey, c_name, 'customer.parquet' as file from customer""")
def lineage(t):
    return t.customer.select("c_custkey", "c_name",
                             snapshots.file_name(F.col("_metadata.file_path")).alias("file"))


@query("round_trip_csv", """
    select o_orderkey, o_orderpriority, o_totalprice,
           case o_orderkey % 5 when 0 then null when 1 then '' when 2 then '  a\\b ' || o_custkey || ' '
               when 3 then 'line' || chr(10) || o_custkey
               else o_orderstatus || ', "' || o_custkey || '"' end as note
    from orders""")
def round_trip_csv(t):
    # NULL, empty text, outer spaces and a backslash, a line break, quotes and a comma.
    kind, buyer = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    note = (F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit(""))
            .when(kind == 2, F.concat(F.lit("  a\\b "), buyer, F.lit(" ")))
            .when(kind == 3, F.concat(F.lit("line\n"), buyer))
            .otherwise(F.concat("o_orderstatus", F.lit(', "'), buyer, F.lit('"'))))
    table = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", note.alias("note"))
    path = writers.export_csv(table, scratch(t.spark, "orders.csv.gz"), ["o_orderkey"])
    return snapshots.read_table_csv(t.spark, path, table.schema)


@query("csv_inferred", "select p_partkey, p_name, p_size, p_retailprice from part")
def csv_inferred(t):
    table = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = writers.export_csv(table, scratch(t.spark, "part.csv.gz"), ["p_partkey"])
    return snapshots.read_table_csv(t.spark, path)


@query("round_trip_json", """
    select c_custkey, cast(c_nationkey as varchar) as league_position,
           '{"href":"' || c_name || '"}' as parent
    from customer""")
def round_trip_json(t):
    # A number that has to come back as text and an object as JSON text, without a schema.
    records = t.customer.select("c_custkey", F.col("c_nationkey").alias("league_position"),
                                F.struct(F.col("c_name").alias("href")).alias("parent"))
    path = writers.export_json(records, scratch(t.spark, "customer.json"))
    return snapshots.read_records(t.spark, path, text=["league_position"], as_json=["parent"])


@query("season_records", """
    select event_id, user_id, event_type, week(ts)::integer as season from events""")
def season_records(t):
    root = _weekly(t)
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType())])
    weeks = snapshots.expand_seasons("1-53")
    weeks = [w for w in weeks if w in _weeks(t)]
    return snapshots.read_seasons(t.spark, root, "*", weeks, schema, "week={}").drop("season_file")


@query("snapshot_text_scan", """
    select week(ts)::integer as season, count(*) as lines, max(event_id) as newest,
           count(*) filter (where event_type = 'view') as views
    from events group by 1""")
def snapshot_text_scan(t):
    paths = snapshots.season_paths(_weekly(t), "*")
    lines = snapshots.read_snapshots(t.spark, paths)
    event = F.from_json("value", "event_id bigint, event_type string")
    return (lines.select("season", event.alias("e")).groupBy("season")
            .agg(F.count("*").alias("lines"), F.max("e.event_id").alias("newest"),
                 F.count_if(F.col("e.event_type") == "view").alias("views")))


@query("season_range", """
    select event_id, user_id, event_type, week(ts)::integer as season from events
    where week(ts) between 1 and 3""")
def season_range(t):
    # The range is the feature: folders of other weeks are not listed.
    schema = "event_id long, user_id long, event_type string"
    return snapshots.read_seasons(t.spark, _weekly(t), "*", snapshots.expand_seasons("1-3"), schema,
                                  "week={}").drop("season_file")


def _weeks(t):
    return {r[0] for r in t.events.select(F.weekofyear("ts")).distinct().collect()}


def _weekly(t):
    """Events as gzip JSON lines, one folder per week standing for the season."""
    root = scratch(t.spark, "events")
    lines = t.events.select(F.weekofyear("ts").alias("week"),
                            F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))
    lines.write.option("compression", "gzip").partitionBy("week").text(root)
    return root


@query("publish_tables", """
    select 'region' as "table", r_regionkey as id, r_name as name from region
    union all select 'nation', n_nationkey, n_name from nation
    union all select 'customer', c_custkey, c_name from customer
    union all select 'version', null, '0123abc'""")
def publish_tables(t):
    # Published twice: readers find the second release as a whole.
    target = scratch(t.spark, "published")
    writers.publish({"region": t.region, "nation": t.nation.limit(0)}, target, "first")
    writers.publish({"region": t.region, "nation": t.nation, "customer": t.customer}, target, "0123abc")
    fields = {"region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name"),
              "customer": ("c_custkey", "c_name")}
    found = Releases(t.spark, target).tables()
    rows = [found[name].select(F.lit(name).alias("table"), F.col(key).cast("long").alias("id"),
                               F.col(text).alias("name")) for name, (key, text) in fields.items()]
    version = found["version"].select(F.lit("version").alias("table"),
                                      F.lit(None).cast("long").alias("id"),
                                      F.col("commit_hash").alias("name"))
    return report([*rows, version])
