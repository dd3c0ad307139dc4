"""Parsers, each fed with texts made from the columns of a table."""

from pyspark.sql import functions as F

from catalog import query
from pitchlake.functions import dates, keys, match, money
from pitchlake.functions import text as tx


@query("path_tokens", r"""
    select page_id, string_split(url, '/')[3] as host, string_split(url, '/')[5] as fifth,
           string_split(url, '/')[9] as beyond,
           string_split(regexp_replace(url, '/+$', ''), '/')[-1] as last_piece,
           nullif(split_part(url, '/', 9), '') as part_beyond,
           regexp_extract(url, '^([a-z]+)://', 1) as scheme
    from pages""")
def path_tokens(t):
    url = F.col("url")
    return t.pages.select(
        "page_id", tx.token(url, 3).alias("host"), tx.token(url, 5).alias("fifth"),
        tx.token(url, 9).alias("beyond"), tx.last_token(url).alias("last_piece"),
        F.nullif(F.split_part(url, F.lit("/"), F.lit(9)), F.lit("")).alias("part_beyond"),
        F.regexp_extract(url, "^([a-z]+)://", 1).alias("scheme"))


@query("market_value_parse", """
    select p_partkey,
           case p_partkey % 6
               when 0 then cast(round((cast(p_retailprice as float))::double * 1e3) as integer)
               when 1 then cast(round((cast(p_retailprice as float))::double * 1e6) as integer)
               when 2 then cast(round((cast(p_retailprice as float))::double * 1e3) as integer)
           end as market_value,
           case p_partkey % 6
               when 0 then cast(p_retailprice as decimal(18,3)) * 1000
               when 1 then cast(p_retailprice as decimal(18,3)) * 1000000
               when 2 then 0
               when 3 then null
               when 4 then cast(p_retailprice as decimal(18,3))
               else 0
           end::decimal(18,3) as fee
    from part""")
def market_value_parse(t):
    # The single-precision number in the SQL is the one the parser has to pass through.
    number = F.format_string("%.1f", F.col("p_retailprice"))
    shape = F.col("p_partkey") % 6
    value = (F.when(shape == 0, F.concat(F.lit("€"), number, F.lit("k")))
             .when(shape == 1, F.concat(F.lit("€"), number, F.lit("m")))
             .when(shape == 2, F.concat(F.lit("£"), number, F.lit("Th")))
             .when(shape == 3, F.lit("-"))
             .when(shape == 4, F.concat(F.lit("€"), number))
             .otherwise(F.lit("free transfer")))
    return t.part.select("p_partkey", money.market_value(value).alias("market_value"),
                         money.transfer_fee(value).alias("fee"))


@query("dirty_numbers", """
    select s_suppkey,
           case s_suppkey % 4 when 0 then cast(round(s_acctbal * 100) as integer)
                              when 1 then null when 2 then null else null end as dotted,
           case s_suppkey % 4 when 0 then cast(s_acctbal as float) when 3 then null end as share,
           case s_suppkey % 4 when 0 then cast(round(s_acctbal * 100) as integer)
                              when 1 then 0 end as counted,
           case s_suppkey % 4 when 0 then 1 when 1 then 0 when 2 then 1 end as filled
    from supplier""")
def dirty_numbers(t):
    shape = F.col("s_suppkey") % 4
    cents = F.round(F.col("s_acctbal") * 100).cast("long").cast("string")
    grouped = F.regexp_replace(cents, r"(?<=\d)(?=(\d{3})+$)", ".")

    def texts(number):
        return (F.when(shape == 0, number).when(shape == 1, F.lit(""))
                .when(shape == 2, F.lit("null")))

    percent = texts(F.concat(F.format_string("%.2f", F.col("s_acctbal")), F.lit(" %")))
    dotted = texts(grouped)
    return t.supplier.select(
        "s_suppkey", tx.thousands(dotted).alias("dotted"), tx.percentage(percent).alias("share"),
        tx.empty_to_zero(F.replace(dotted, F.lit("."), F.lit(""))).alias("counted"),
        tx.flag(F.length(dotted) > 0).alias("filled"))


@query("mixed_dates", """
    select o_orderkey,
           case when o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end as game_date,
           case when o_orderkey % 7 = 0 then make_date(cast(year(o_orderdate) as bigint), 1, 1)
                when o_orderkey % 7 = 1 then null
                else cast(o_orderdate as date) end as birth_date,
           case when o_orderkey % 5 = 0 then null else cast(o_orderdate as date) end as iso
    from orders""")
def mixed_dates(t):
    # Month first up to 1998, day first later; two-digit years of the 1900s and 2000s.
    key, day, year = F.col("o_orderkey"), F.col("o_orderdate"), F.year("o_orderdate")
    weekday = F.date_format(day, "EEE, ")
    game = F.when(key % 11 == 0, F.lit("null")).otherwise(F.concat(weekday, F.when(
        year >= 1999, F.date_format(day, "dd/MM/yy")).otherwise(F.date_format(day, "MM/dd/yy"))))
    born = (F.when(key % 7 == 0, year.cast("string")).when(key % 7 == 1, F.lit("N/A"))
            .when(key % 7 == 2, F.date_format(day, "dd/MM/yyyy"))
            .otherwise(F.date_format(day, "MMM dd, yyyy")))
    iso = F.when(key % 5 == 0, F.lit("0000-00-00")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return t.orders.select(
        "o_orderkey",
        dates.era_date(game, year, F.lit(False), switch=1999).alias("game_date"),
        dates.birth_date(born).alias("birth_date"), dates.iso_date(iso).alias("iso"))


@query("contract_dates", """
    select o_orderkey,
           case o_orderkey % 4
               when 0 then cast(o_orderdate as date)
               when 1 then cast(o_orderdate as date)
               when 2 then cast(date_trunc('month', o_orderdate) as date)
           end as contract_date
    from orders""")
def contract_dates(t):
    key, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = (F.when(key == 0, F.date_format(day, "dd/MM/yyyy"))
            .when(key == 1, F.date_format(day, "MMM d, yyyy"))
            .when(key == 2, F.date_format(day, "MMM, yyyy"))
            .otherwise(F.lit("-")))
    return t.orders.select("o_orderkey", dates.contract_date(text).alias("contract_date"))


@query("clamp_date", """
    select o_orderkey, least(cast(o_orderdate as date), date '1999-06-30') as clamped from orders""")
def clamp_date(t):
    return t.orders.select("o_orderkey", dates.clamp(
        F.to_date("o_orderdate"), dates.run_date("1999-06-30")).alias("clamped"))


@query("bucket_mapping", """
    select p_partkey, case when p_type in ('ECONOMY', 'SMALL') then 'light'
                           when p_type = 'LARGE' then 'heavy' else 'other' end as weight
    from part""")
def bucket_mapping(t):
    groups = {"light": ("ECONOMY", "SMALL"), "heavy": ("LARGE",)}
    return t.part.select("p_partkey", match.bucket(F.col("p_type"), groups, "other").alias("weight"))


@query("score_text", """
    select l_orderkey, l_linenumber,
           case when l_linenumber <> 7 then cast(l_quantity as integer) end as home_goals,
           case when l_linenumber <> 7 then l_linenumber end as away_goals,
           case l_partkey % 4 when 0 then cast(l_quantity as integer) when 1 then -1 when 2 then -1
           end as position,
           cast(l_extendedprice as integer) as attendance
    from lineitem""")
def score_text(t):
    quantity, line = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    score = F.when(line == 7, F.lit("-:-")).otherwise(
        F.concat(quantity, F.lit(":"), line.cast("string")))
    shape = F.col("l_partkey") % 4
    position = (F.when(shape == 0, F.concat(F.lit("Position: "), quantity))
                .when(shape == 1, F.lit("")).when(shape == 2, F.lit("null")))
    visitors = F.rint("l_extendedprice").cast("long").cast("string")
    sheet = F.concat(F.lit("Attendance: "),
                     F.regexp_replace(visitors, r"(?<=\d)(?=(\d{3})+$)", "."))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", match.goals(score, 1).alias("home_goals"),
        match.goals(score, 2).alias("away_goals"),
        match.table_position(position).alias("position"),
        match.attendance(sheet).alias("attendance"))


@query("height_parse", """
    select p_partkey, case when p_partkey % 10 = 0 then null else 150 + p_size end as height_in_cm
    from part""")
def height_parse(t):
    cm = F.col("p_size") + 150
    text = F.when(F.col("p_partkey") % 10 == 0, F.lit("null")).otherwise(F.concat(
        F.floor(cm / 100).cast("string"),
        F.element_at(F.array(*[F.lit(m) for m in ",‚' ´"]), (F.col("p_partkey") % 5 + 1).cast("int")),
        F.lpad((cm % 100).cast("string"), 2, "0"), F.lit(" m")))
    return t.part.select("p_partkey", match.height_cm(text).alias("height_in_cm"))


@query("surrogate_key", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, md5(
        cast(l_orderkey as varchar) || '-' ||
        coalesce(case when l_linenumber = 1 then null else cast(l_linenumber as varchar) end,
                 '_dbt_utils_surrogate_key_null_') || '-' ||
        cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar) || '-' ||
        coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')) as row_key
    from lineitem""")
def surrogate_key(t):
    key = keys.surrogate_key(
        "l_orderkey", F.when(F.col("l_linenumber") != 1, F.col("l_linenumber")),
        "l_partkey", "l_suppkey", F.nullif("l_returnflag", F.lit("N")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             "l_returnflag", key.alias("row_key"))


@query("clean_projection", r"""
    select p_partkey, upper(left(p_name, 1)) || substring(p_name, 2) as title,
           left(p_type, 3) as head, right(p_type, 2) as tail, substring(p_name, 3, 4) as middle,
           length(p_name) as name_length, trim('  ' || p_name || ' ') as trimmed,
           replace(p_brand, 'Brand#', '') as brand_number,
           regexp_replace(p_name, '[aeiou]', '') as first_vowel_gone,
           regexp_replace(p_name, '[aeiou]', '', 'g') as vowels_gone,
           regexp_replace(p_name, '\s+', '', 'g') as squeezed,
           string_split_regex(p_name, '\s+')[2] as second_word,
           nullif(p_type, 'SMALL') as type_or_null,
           coalesce(nullif(p_type, 'SMALL'), 'tiny') as type_filled,
           round(p_retailprice / 7, 1) as seventh,
           p_name || '/' || nullif(p_type, 'SMALL') as joined,
           regexp_extract(p_brand, '[0-9]+') as digits
    from part
    where (p_name like '%ring%' or regexp_full_match(p_brand, 'Brand#[0-9]'))
      and p_size between 5 and 40 and p_type not in ('LARGE') and p_name <> 'red widget'
      and p_retailprice is not null""")
def clean_projection(t):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    kept = t.part.filter(
        (name.like("%ring%") | brand.rlike("^Brand#[0-9]$"))
        & F.col("p_size").between(5, 40) & ~kind.isin("LARGE") & (name != "red widget")
        & F.col("p_retailprice").isNotNull())
    no_small = F.nullif(kind, F.lit("SMALL"))
    return kept.select(
        "p_partkey",
        F.concat(F.upper(F.left(name, F.lit(1))), F.substring(name, F.lit(2), F.length(name))).alias("title"),
        F.left(kind, F.lit(3)).alias("head"), F.right(kind, F.lit(2)).alias("tail"),
        F.substring(name, 3, 4).alias("middle"),
        F.length(name).cast("long").alias("name_length"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.replace(brand, F.lit("Brand#"), F.lit("")).alias("brand_number"),
        tx.drop_first(name, "[aeiou]").alias("first_vowel_gone"),
        F.regexp_replace(name, "[aeiou]", "").alias("vowels_gone"),
        tx.squeeze(name).alias("squeezed"),
        F.get(F.split(name, r"\s+"), F.lit(1)).alias("second_word"),
        no_small.alias("type_or_null"), F.coalesce(no_small, F.lit("tiny")).alias("type_filled"),
        F.round(F.col("p_retailprice") / 7, 1).alias("seventh"),
        F.concat(name, F.lit("/"), no_small).alias("joined"),
        F.regexp_extract(brand, "[0-9]+", 0).alias("digits"))
