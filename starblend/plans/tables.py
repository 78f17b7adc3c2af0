"""Ratings, pairs and side tables derived from the star-schema parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starblend.functions.profiles import COMPLIMENTS, DAYS


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rating_rows(
    spark: SparkSession, folder: str, item: str = "l_suppkey", stars: Column | None = None
) -> DataFrame:
    """Every line item as a rating of its supplier (or part) by the customer of its order."""
    lines = load(spark, folder, "lineitem")
    orders = load(spark, folder, "orders")
    if stars is None:
        stars = (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("double")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col(item).alias("business_id"),
        stars.alias("stars"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", stars.alias("s")).alias("row_id"),
    )


def line_order() -> Column:
    """``row_id`` of ``rating_rows`` as one number of the same order, which aggregations can hash."""
    return F.expr(
        "CAST(unix_micros(CAST(row_id.l_shipdate AS TIMESTAMP)) AS DECIMAL(19, 0)) * CAST(1000000000000000 AS DECIMAL(16, 0))"
        " + CAST(row_id.l_orderkey * 100 + row_id.l_linenumber * 10 + CAST(row_id.s AS INT) AS DECIMAL(19, 0))"
    )


def in_test() -> Column:
    return (F.col("user_id") * 31 + F.col("business_id") * 17) % 10 == 0


def train_rows(ratings: DataFrame) -> DataFrame:
    return ratings.where(~in_test())


def test_rows(ratings: DataFrame) -> DataFrame:
    """Held-out rows as pairs to score, with their stars as truth."""
    return ratings.where(in_test()).withColumnRenamed("stars", "truth")


def side_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in the shape of the user file."""
    return load(spark, folder, "customer").selectExpr(
        "c_custkey AS user_id",
        "CAST(c_custkey % 40 AS STRING) AS review_count",
        "CASE WHEN c_custkey % 9 = 0 THEN NULL "
        "ELSE concat(CAST(1 + c_custkey % 4 AS STRING), '.5') END AS average_stars",
        "CAST(c_nationkey AS STRING) AS fans",
        "CAST(c_custkey % 3 AS STRING) AS useful",
        "concat(CAST(c_custkey % 6 AS STRING), '.7') AS cool",
        "CASE c_custkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN '2012, 2013,' ELSE c_mktsegment END AS elite",
        "CASE WHEN c_custkey % 7 = 0 THEN '' "
        "ELSE concat(CAST(2000 + c_custkey % 20 AS STRING), '-03-04') END AS yelping_since",
        *[
            f"CAST((c_custkey * {i + 1} + c_nationkey) % {i + 5} AS STRING) AS {name}"
            for i, name in enumerate(COMPLIMENTS)
        ],
        "struct(c_custkey) AS row_id",
    )


def side_businesses(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in the shape of the business file; their ids are those of the suppliers and beyond."""
    opening = ", ".join(
        f"'{day}', CASE WHEN (p_partkey + {d}) % 3 = 0 THEN '9:0-17:0' END"
        for d, day in enumerate(DAYS)
    )
    return load(spark, folder, "part").selectExpr(
        "p_partkey AS business_id",
        "CAST(p_partkey % 50 AS STRING) AS review_count",
        "concat(CAST(1 + p_size % 4 AS STRING), '.5') AS stars",
        "CASE WHEN p_partkey % 5 > 0 THEN CAST(p_partkey % 2 AS STRING) END AS is_open",
        "CASE WHEN p_partkey % 8 > 0 THEN replace(p_name, ' ', ', ') END AS categories",
        "CAST(p_size AS STRING) AS latitude",
        "concat('-', CAST(p_size AS STRING), '.25') AS longitude",
        "concat(' ', p_brand) AS city",
        "CASE WHEN p_partkey % 6 > 0 THEN lower(p_type) END AS state",
        "CASE WHEN p_partkey % 4 > 0 THEN "
        "map('RestaurantsPriceRange2', CAST(p_size % 7 AS STRING)) END AS attributes",
        f"map({opening}) AS hours",
        "struct(p_partkey) AS row_id",
    )


def side_checkins(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        F.col("user_id").alias("business_id"), F.from_json("props", "map<string,bigint>").alias("time")
    )


def side_tips(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").selectExpr(
        "l_suppkey AS business_id", "CAST(l_linenumber AS STRING) AS likes"
    )


def side_photos(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").selectExpr("l_partkey AS business_id")
