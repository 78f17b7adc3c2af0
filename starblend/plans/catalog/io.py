"""Round trips through the text and JSON formats: rows of the tables are written, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from starblend import sources
from starblend.functions.profiles import COMPLIMENTS
from starblend.operators import biases, profile
from starblend.plans.catalog.registry import biases_sql, query, ratings_sql, space
from starblend.plans.tables import line_order, load, rating_rows, test_rows, train_rows

DENSE = f"WITH {ratings_sql()}"


def _write_lines(lines, spark, name):
    """A text file whose parts each start with a header, as a writer with headers makes them."""
    path = space(spark).path(name)
    lines.write.option("header", True).option("quote", "").option("emptyValue", "").csv(path)
    return path


def _write_json(rows, spark, name):
    path = space(spark).path(name)
    rows.write.json(path)
    return path


@query(f"""{DENSE}
SELECT CAST(user_id AS VARCHAR) || '"' AS user_id, CAST(business_id AS VARCHAR) AS business_id, stars
FROM ratings""")
def read_ratings(spark, sf):
    """User ids carry a quote sign, which must stay an ordinary character."""
    rows = rating_rows(spark, sf).select(
        F.concat(F.col("user_id").cast("string"), F.lit('"')).alias("user_id"), "business_id", "stars"
    )
    path = _write_lines(rows, spark, "ratings-text")
    return sources.read_ratings(spark, path).drop("row_id")


@query(f"""{DENSE}
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id,
  CASE WHEN l_orderkey % 3 <> 0 THEN stars END AS truth FROM test""")
def read_pairs(spark, sf):
    """A third of the lines have two fields."""
    pairs = test_rows(rating_rows(spark, sf))
    line = F.when(
        F.col("row_id.l_orderkey") % 3 != 0, F.concat_ws(",", "user_id", "business_id", "truth")
    ).otherwise(F.concat_ws(",", "user_id", "business_id"))
    path = space(spark).path("pairs-text")
    pairs.select(line.alias("user_id,business_id,stars")).write.option("header", True).option(
        "quote", ""
    ).option("sep", "\t").csv(path)
    return sources.read_pairs(spark, path).drop("row_id")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS VARCHAR) AS review_count,
  c_mktsegment AS elite, CAST(NULL AS VARCHAR) AS fans,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 7 AS VARCHAR) END AS compliment_hot,
  c_name AS yelping_since
FROM customer""")
def read_users(spark, sf):
    rows = load(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_nationkey").alias("review_count"),
        F.col("c_mktsegment").alias("elite"),
        F.col("c_name").alias("yelping_since"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 7).alias("compliment_hot"),
        F.lit("not read").alias("name"),
    )
    users = sources.read_users(spark, _write_json(rows, spark, "users-json"))
    return users.select("user_id", "review_count", "elite", "fans", COMPLIMENTS[0], "yelping_since")


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS business_id, s_name AS categories, n_name AS city,
  CAST(s_nationkey AS VARCHAR) AS price, CASE WHEN s_suppkey % 2 = 0 THEN '8-17' END AS monday
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def read_businesses(spark, sf):
    rows = load(spark, sf, "supplier").join(
        load(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").cast("string").alias("business_id"),
        F.col("s_name").alias("categories"),
        F.col("n_name").alias("city"),
        F.struct(F.col("s_nationkey").alias("RestaurantsPriceRange2")).alias("attributes"),
        F.when(F.col("s_suppkey") % 2 == 0, F.struct(F.lit("8-17").alias("Monday"))).alias("hours"),
    )
    found = sources.read_businesses(spark, _write_json(rows, spark, "businesses-json"))
    return found.select(
        "business_id", "categories", "city",
        F.try_element_at("attributes", F.lit("RestaurantsPriceRange2")).alias("price"),
        F.try_element_at("hours", F.lit("Monday")).alias("monday"),
    )


@query("""
SELECT CAST(user_id AS VARCHAR) AS business_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events""")
def read_checkins(spark, sf):
    rows = load(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("business_id"),
        F.from_json("props", "map<string,bigint>").alias("time"),
    )
    found = sources.read_checkins(spark, _write_json(rows, spark, "checkins-json"))
    return found.select("business_id", F.try_element_at("time", F.lit("k")).alias("k"))


@query("""
SELECT CAST(l_suppkey AS VARCHAR) AS business_id, CAST(l_linenumber AS VARCHAR) AS likes
FROM lineitem""")
def read_tips(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("business_id"), F.col("l_linenumber").alias("likes")
    )
    return sources.read_tips(spark, _write_json(rows, spark, "tips-json")).drop("row_id")


@query("SELECT CAST(l_partkey AS VARCHAR) AS business_id FROM lineitem")
def read_photos(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("business_id"), F.col("l_returnflag").alias("label")
    )
    return sources.read_photos(spark, _write_json(rows, spark, "photos-json")).drop("row_id")


@query(f"""{DENSE}, {biases_sql()}
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id,
  printf('%.3f', greatest(1, least(5, m + coalesce(bu, 0) + coalesce(bi, 0)))) AS prediction
FROM test LEFT JOIN u4 USING (user_id) LEFT JOIN b4 USING (business_id), g""")
def write_predictions(spark, sf):
    """Written, then read back as text."""
    work = space(spark)
    ratings = work.table(rating_rows(spark, sf), "ratings")
    train = train_rows(ratings)
    mean = profile.global_mean(train).first()["global_mean"]
    history = work.table(profile.dedupe_ratings(train, line_order()), "history")
    bu, bi = biases.fit_biases(history, mean, work=work)
    scored = biases.bias_predict(test_rows(ratings), bu, bi, mean)
    path = work.path("predictions")
    sources.write_predictions(scored, path, "bias")
    return (
        spark.read.schema("user_id string, business_id string, prediction string")
        .option("header", True).csv(path)
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS user_id, CAST(o_custkey AS VARCHAR) AS business_id,
  row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id
FROM orders""")
def line_numbers(spark, sf):
    """Parts in the order of their keys, with copies of the header throughout, read in many splits."""
    work = space(spark)
    head = "user_id,business_id,stars"
    line = F.concat_ws(",", "o_orderkey", "o_custkey", F.lit("3"))
    first = load(spark, sf, "orders").agg(F.min("o_orderkey")).first()[0]
    copies = F.when(
        (F.col("o_orderkey") % 7 == 0) | (F.col("o_orderkey") == first), F.array(F.lit(head), line)
    ).otherwise(F.array(line))
    path = work.path("lines-text")
    (
        load(spark, sf, "orders").repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey")
        .select(F.explode(copies).alias("value")).write.text(path)
    )
    numbered = sources.line_numbers(work.table(sources.read_ratings(spark, path), "lines"))
    return numbered.select("user_id", "business_id", "row_id")


@query("""
SELECT 'present' AS path, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL SELECT 'absent', NULL""")
def optional_source(spark, sf):
    """The rows of a source that is there, and none at all of one that is not."""
    rows = load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("business_id"), F.lit("1").alias("likes"))
    there = _write_json(rows, spark, "tips-json")
    found = [("present", there), ("absent", space(spark).path("no-tips-json"))]
    counts = [(name, sources.optional_source(sources.read_tips, spark, path)) for name, path in found]
    parts = [
        spark.range(1).select(F.lit(name).alias("path"), F.lit(None).cast("long").alias("n")) if df is None
        else df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("path"), "n")
        for name, df in counts
    ]
    return parts[0].unionByName(parts[1])
