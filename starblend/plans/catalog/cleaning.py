"""Scalar cleaning over text that the tables' own columns are turned into."""

from __future__ import annotations

from pyspark.sql import functions as F

from starblend import functions as S
from starblend.functions.profiles import COMPLIMENTS, DAYS
from starblend.plans.catalog.registry import query, r6, sql_r6
from starblend.plans.tables import load

# One text per customer: well-formed numbers and every kind of broken one.
NUMBER_TEXT = """CASE c_custkey % 12
  WHEN 0 THEN CAST(c_acctbal AS STRING)
  WHEN 1 THEN concat(' ', CAST(c_custkey AS STRING), ' ')
  WHEN 2 THEN 'None'
  WHEN 3 THEN ''
  WHEN 4 THEN 'inf'
  WHEN 5 THEN 'nan'
  WHEN 6 THEN concat(CAST(c_custkey AS STRING), 'e3')
  WHEN 7 THEN concat('-', CAST(c_custkey AS STRING), '.9')
  WHEN 8 THEN concat(CAST(c_custkey AS STRING), '_000')
  WHEN 9 THEN NULL
  WHEN 10 THEN concat(CAST(c_custkey AS STRING), 'd')
  ELSE c_name END"""
NUMBER_SQL = NUMBER_TEXT.replace("AS STRING", "AS VARCHAR")


@query(f"""
WITH t AS (SELECT c_custkey, {NUMBER_SQL} AS s FROM customer)
SELECT c_custkey, s,
  CASE c_custkey % 12
    WHEN 0 THEN CAST(trunc(c_acctbal) AS BIGINT)
    WHEN 1 THEN c_custkey
    WHEN 6 THEN c_custkey * 1000
    WHEN 7 THEN -c_custkey
    WHEN 8 THEN c_custkey * 1000
    ELSE 7 END AS as_int
FROM t JOIN customer USING (c_custkey)""")
def safe_int(spark, sf):
    text = load(spark, sf, "customer").select("c_custkey", F.expr(NUMBER_TEXT).alias("s"))
    return text.select("c_custkey", "s", S.safe_int("s", 7).alias("as_int"))


@query(f"""
WITH t AS (SELECT c_custkey, c_acctbal, {NUMBER_SQL} AS s FROM customer)
SELECT c_custkey, s,
  CAST(CASE c_custkey % 12
    WHEN 0 THEN c_acctbal
    WHEN 1 THEN c_custkey
    WHEN 4 THEN CAST('inf' AS DOUBLE)
    WHEN 5 THEN -1
    WHEN 6 THEN c_custkey * 1000
    WHEN 7 THEN -(c_custkey + 0.9)
    WHEN 8 THEN c_custkey * 1000
    ELSE 3.5 END AS DOUBLE) AS as_float
FROM t""")
def safe_float(spark, sf):
    text = load(spark, sf, "customer").select("c_custkey", F.expr(NUMBER_TEXT).alias("s"))
    number = S.safe_float("s", 3.5)
    return text.select(
        "c_custkey", "s", F.when(F.isnan(number), F.lit(-1.0)).otherwise(number).alias("as_float")
    )


@query("""
SELECT o_orderkey,
  CASE WHEN o_totalprice / 100000 - 1 < 1 THEN CAST(1 AS DOUBLE)
       WHEN o_totalprice / 100000 - 1 > 5 THEN CAST(5 AS DOUBLE)
       ELSE round(o_totalprice / 100000 - 1, 8) END AS clamped,
  round(CASE WHEN o_totalprice / 100000 - 3 < -1.5 THEN CAST(-1.5 AS DOUBLE)
       WHEN o_totalprice / 100000 - 3 > 1.5 THEN CAST(1.5 AS DOUBLE)
       ELSE o_totalprice / 100000 - 3 END, 8) + CAST(0 AS DOUBLE) AS winsorised
FROM orders""")
def clamp(spark, sf):
    price = F.col("o_totalprice") / 100000
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.round(S.clamp(price - 1), 8).alias("clamped"),
        (F.round(S.winsorise(price - 3, 1.5), 8) + F.lit(0.0)).alias("winsorised"),
    )


@query(f"""
SELECT c_custkey,
  {sql_r6("sign(c_acctbal) * pow(abs(c_acctbal / 10000), CAST(1.1 AS DOUBLE))")} AS weight,
  least(c_custkey, c_nationkey * 40) AS item_a, greatest(c_custkey, c_nationkey * 40) AS item_b
FROM customer""")
def signed_power_and_pair_key(spark, sf):
    a, b = S.pair_key("c_custkey", F.col("c_nationkey") * F.lit(40))
    return load(spark, sf, "customer").select(
        "c_custkey",
        r6(S.signed_power(F.col("c_acctbal") / 10000, 1.1)).alias("weight"),
        a.alias("item_a"),
        b.alias("item_b"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       printf('%.3f', 1 + l_extendedprice / 32768) AS three,
       printf('%.3f', 1 + l_quantity / 16) AS ties
FROM lineitem""")
def three_decimals(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        S.three_decimals(1 + F.col("l_extendedprice") / 32768).alias("three"),
        S.three_decimals(1 + F.col("l_quantity") / 16).alias("ties"),
    )


DATE_TEXT = """CASE o_orderkey % 6
  WHEN 0 THEN ''
  WHEN 1 THEN NULL
  WHEN 2 THEN o_orderpriority
  WHEN 3 THEN concat(CAST(year(o_orderdate) + 30 AS STRING), '-05-01')
  WHEN 4 THEN concat(' ', CAST(year(o_orderdate) AS STRING), ' ')
  ELSE concat(CAST(year(o_orderdate) AS STRING), '-01-02 10:00:00') END"""


@query("""
SELECT o_orderkey,
  CAST(CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0
    WHEN 2 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
    WHEN 3 THEN year(o_orderdate) + 30 ELSE year(o_orderdate) END AS INTEGER) AS joined
FROM orders""")
def parse_year(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", S.parse_year(F.expr(DATE_TEXT)).alias("joined")
    )


@query("""
SELECT o_orderkey,
  CAST(greatest(0, 2025 - CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0
    WHEN 2 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
    WHEN 3 THEN year(o_orderdate) + 30 ELSE year(o_orderdate) END) AS INTEGER) AS age
FROM orders""")
def account_age(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", S.account_age(F.expr(DATE_TEXT)).alias("age")
    )


LIST_TEXT = """CASE p_partkey % 5
  WHEN 0 THEN concat(replace(p_name, ' ', ', '), ',, ')
  WHEN 1 THEN ''
  WHEN 2 THEN NULL
  WHEN 3 THEN concat(' ,', replace(p_name, ' ', ' ,'), ',', p_type)
  ELSE p_name END"""


@query("""
SELECT p_partkey,
  CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', '|') WHEN 1 THEN '' WHEN 2 THEN ''
    WHEN 3 THEN replace(p_name, ' ', '|') || '|' || p_type ELSE p_name END AS parts,
  CAST(CASE p_partkey % 5 WHEN 0 THEN len(string_split(p_name, ' ')) WHEN 1 THEN 0 WHEN 2 THEN 0
    WHEN 3 THEN len(string_split(p_name, ' ')) + 1 ELSE 1 END AS INTEGER) AS n
FROM part""")
def parse_list(spark, sf):
    parts = S.parse_list(F.expr(LIST_TEXT))
    return load(spark, sf, "part").select(
        "p_partkey", F.array_join(parts, "|").alias("parts"), F.size(parts).alias("n")
    )


@query("""
SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 0
  WHEN 2 THEN len(string_split(p_name, ' ')) ELSE 1 END AS INTEGER) AS years
FROM part""")
def elite_len(spark, sf):
    text = F.expr("""CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'None'
        WHEN 2 THEN concat(replace(p_name, ' ', ','), ', ') ELSE p_name END""")
    return load(spark, sf, "part").select("p_partkey", S.elite_len(text).alias("years"))


@query("""
SELECT p_partkey,
  CAST(CASE p_partkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN least(p_size, 4)
    WHEN 3 THEN 0 WHEN 4 THEN 2 ELSE least(p_size, 4) END AS BIGINT) AS price
FROM part""")
def parse_price(spark, sf):
    attributes = F.expr("""CASE p_partkey % 6
        WHEN 0 THEN NULL
        WHEN 1 THEN map('GoodForKids', 'True')
        WHEN 2 THEN map('RestaurantsPriceRange2', CAST(p_size AS STRING))
        WHEN 3 THEN map('RestaurantsPriceRange2', concat('-', CAST(p_size AS STRING)))
        WHEN 4 THEN map('RestaurantsPriceRange2', p_name)
        ELSE map('RestaurantsPriceRange2', concat(CAST(p_size AS STRING), '.9')) END""")
    return load(spark, sf, "part").select("p_partkey", S.parse_price(attributes).alias("price"))


_COUNTER = "(c_custkey * {step} + c_nationkey) % 13"


@query("SELECT c_custkey, CAST("
       + " + ".join(f"(CASE WHEN {_COUNTER.format(step=i + 1)} > 9 THEN 0 "
                    f"ELSE {_COUNTER.format(step=i + 1)} END)" for i in range(len(COMPLIMENTS)))
       + " AS BIGINT) AS total, CAST((c_custkey * 11 + c_nationkey) % 13 AS BIGINT) AS last_raw "
         "FROM customer")
def compliments(spark, sf):
    texts = {
        name: F.expr(f"CASE WHEN {_COUNTER.format(step=i + 1)} > 9 THEN 'many' "
                     f"ELSE CAST({_COUNTER.format(step=i + 1)} AS STRING) END")
        for i, name in enumerate(COMPLIMENTS)
    }
    counted = load(spark, sf, "customer").withColumns(texts)
    return counted.select(
        "c_custkey",
        S.compliment_sum(S.compliments()).alias("total"),
        F.expr("(c_custkey * 11 + c_nationkey) % 13").cast("bigint").alias("last_raw"),
    )


@query("SELECT s_suppkey, " + ", ".join(
    f"CAST(CASE WHEN s_suppkey % 9 <> 0 AND (s_suppkey + {d}) % 4 = 0 THEN 1 ELSE 0 END AS DOUBLE)"
    f" AS b_open_{day[:3]}" for d, day in enumerate(DAYS)) + " FROM supplier")
def open_flags(spark, sf):
    entries = ", ".join(
        f"'{day}', CASE (s_suppkey + {d}) % 4 WHEN 0 THEN '9:0-17:0' WHEN 1 THEN '' "
        f"WHEN 2 THEN 'None' END"
        for d, day in enumerate(DAYS)
    )
    hours = F.expr(f"CASE WHEN s_suppkey % 9 <> 0 THEN map({entries}) END")
    return load(spark, sf, "supplier").select("s_suppkey", *S.open_flags(hours))


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE lower(n_name) END AS city,
  CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE upper(n_name) END AS state
FROM nation""")
def norm_place(spark, sf):
    text = F.expr("""CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('  ', n_name)
        WHEN 2 THEN concat(lower(n_name), '\\t') ELSE n_name END""")
    return load(spark, sf, "nation").select(
        "n_nationkey", S.norm_city(text).alias("city"), S.norm_state(text).alias("state")
    )


@query("""
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0
  ELSE CAST(json_extract(props, '$.k') AS BIGINT) * 2 END AS total
FROM events""")
def map_sum(spark, sf):
    bucket = F.from_json("props", "map<string,bigint>")
    doubled = F.map_concat(bucket, F.transform_keys(bucket, lambda k, _: F.concat(k, F.lit("2"))))
    times = F.when(F.col("event_id") % 10 != 0, doubled)
    return load(spark, sf, "events").select("event_id", S.map_sum(times).alias("total"))


@query("""
SELECT p_partkey,
  CASE WHEN len(string_split(p_name, ' ')) >= 1 THEN CAST(len(string_split(p_name, ' ')[1]) AS DOUBLE) ELSE 0 END AS c0,
  CAST(coalesce(len(string_split(p_name, ' ')[2]), 0) AS DOUBLE) AS c1,
  CAST(coalesce(len(string_split(p_name, ' ')[3]), 0) AS DOUBLE) AS c2,
  CAST(len(string_split(p_name, ' ')[1]) AS DOUBLE) AS cut
FROM part""")
def fix_width(spark, sf):
    lengths = F.transform(F.split("p_name", " "), lambda w: F.length(w).cast("double"))
    three, one = S.fix_width(lengths, 3), S.fix_width(lengths, 1)
    return load(spark, sf, "part").select(
        "p_partkey", three[0].alias("c0"), three[1].alias("c1"), three[2].alias("c2"),
        one[0].alias("cut"),
    )
