"""The physical plans that the cluster would run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starblend.operators import features, latent, neighbours, profile
from starblend.plans import tables
from starblend.plans.catalog import QUERIES
from starblend.plans.presets import AGGRESSIVE

FOLDER = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def count(text: str, what: str) -> int:
    return sum(line.lstrip(" :+-*()0123456789").startswith(what) for line in text.splitlines())


@pytest.fixture
def no_broadcast(spark):
    """What Spark does when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture
def stored(spark, work):
    ratings = spark.range(2000).selectExpr(
        "id % 40 AS user_id", "id % 31 AS business_id", "CAST(id % 5 + 1 AS DOUBLE) AS stars",
        "id AS row_id",
    )
    return work.table(ratings, "ratings")


def test_counts_read_one_column(stored):
    text = profile.user_counts(stored)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<user_id:bigint>" in text
    assert "partial_count" in text


def test_scan_of_the_tables_is_pruned(spark):
    text = plan(profile.global_mean(tables.rating_rows(spark, FOLDER)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_dedupe_by_line_number_hashes_and_does_not_sort(stored, no_broadcast):
    text = plan(profile.dedupe_ratings(stored))
    assert count(text, "HashAggregate") == 2 and "Sort" not in text
    assert count(text, "Exchange") == 1


def test_registered_dedupe_hashes_and_does_not_sort(spark, no_broadcast):
    text = plan(QUERIES["dedupe_ratings"](spark, FOLDER))
    final = text[: text.index("SortMergeJoin")]
    assert count(final, "HashAggregate") == 2 and "SortAggregate" not in text and "ObjectHash" not in text


def test_registered_profile_reads_the_ratings_twice(spark):
    """Once for the mean and the histogram, once for the pairs to score; the rest are the stored counts."""
    text = plan(QUERIES["ratings_profile"](spark, FOLDER))
    assert sum("lineitem.parquet" in line for line in text.splitlines() if "FileScan" in line) <= 3


def test_implicit_vectors_take_one_join_and_one_shuffle_of_sums(spark, work, no_broadcast):
    rank = AGGRESSIVE.rank
    history = work.table(spark.range(500).selectExpr("id % 20 AS user_id", "id % 31 AS business_id"), "history")
    factors = spark.range(31).select(F.col("id").alias("business_id"), F.array(*[F.rand(d) for d in range(rank)]).alias("q"))
    found = latent.implicit_user_vectors(history, work.table(factors, "factors"), rank)
    text = plan(found)
    assert count(text, "SortMergeJoin") == 1 and count(text, "Exchange") == 3  # both sides of the join, then the sums
    assert sum("partial_" in line for line in text.splitlines() if "Aggregate" in line) == 1 and "Python" not in text
    assert len(found.first()["y"]) == rank


def test_pair_join_shuffles_the_ratings_once(stored, no_broadcast):
    capped = neighbours.cap_user_items(stored.drop("row_id"), 10, "stars")
    text = plan(neighbours.item_similarities(capped))
    assert count(text, "SortMergeJoin") == 1
    # the ratings by user, reused by the other side, and the summed moments by pair
    assert count(text, "Exchange") == 2 and count(text, "ReusedExchange") == 1
    # the window's order serves the join: no sort between the two
    between = text[text.index("SortMergeJoin"):text.index("Window ")]
    assert "Sort [" not in between


def test_top_neighbours_are_cut_before_the_shuffle(spark, work, stored, no_broadcast):
    sims = work.table(spark.range(31).selectExpr(
        "id AS item_a", "id + 1 AS item_b", "0.5D AS sim"), "sims")
    targets = work.table(stored.select("user_id", "business_id").distinct(), "targets")
    residuals = stored.select("user_id", "business_id", F.lit(0.1).alias("resid"))
    text = plan(neighbours.cf_adjustments(targets, residuals, sims, work, k=2))
    assert "WindowGroupLimit" in text
    # the final sums reuse the partitioning of the window
    assert text.index("HashAggregate") < text.index("Window ") < text.index("Exchange")


def test_side_tables_meet_in_one_shuffle(spark, no_broadcast):
    by_item = spark.range(10).selectExpr("id AS business_id", "id AS n")
    tips = spark.range(10).selectExpr("id AS business_id", "'1' AS likes")
    photos = spark.range(10).selectExpr("id AS business_id")
    text = plan(features.business_table(None, None, tips, photos, by_item))
    assert "Join" not in text


def test_there_is_no_python_in_the_plans(spark, work):
    users = features.user_columns(tables.side_users(spark, FOLDER))
    businesses = features.business_columns(tables.side_businesses(spark, FOLDER))
    for frame in (users, businesses):
        assert "Python" not in plan(frame)
