"""Counts, means and other figures that describe a set of ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the mean assumed for an empty rating set.
EMPTY_MEAN = 3.5


def global_mean(ratings: DataFrame) -> DataFrame:
    """One row ``global_mean`` over every rating row."""
    return ratings.agg(F.coalesce(F.avg("stars"), F.lit(EMPTY_MEAN)).alias("global_mean"))


def dedupe_ratings(ratings: DataFrame, order: str | Column = "row_id") -> DataFrame:
    """One row per (user, item) with the stars that come last by ``order``.

    With a number as ``order`` the aggregation hashes; a struct makes it sort, so number the lines first.
    """
    order = F.col(order) if isinstance(order, str) else order
    return ratings.groupBy("user_id", "business_id").agg(F.max_by("stars", order).alias("stars"))


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def user_counts(ratings: DataFrame) -> DataFrame:
    return key_counts(ratings, "user_id")


def item_counts(ratings: DataFrame) -> DataFrame:
    return key_counts(ratings, "business_id")


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """``stars, n`` for whole stars 1..5, zero where there are none; other values are left out."""
    spark = ratings.sparkSession
    levels = spark.range(1, 6).select(F.col("id").cast("int").alias("stars"))
    seen = (
        ratings.select(F.col("stars").cast("int").alias("stars"))
        .where(F.col("stars").between(1, 5))
        .groupBy("stars")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return levels.join(F.broadcast(seen), "stars", "left").select(
        "stars", F.coalesce("n", F.lit(0)).alias("n")
    )


def count_profile(counts: DataFrame) -> DataFrame:
    """Minimum, median, mean and maximum of ``counts.n``; an even number averages the middle two.

    The counts are first grouped by value.  Distinct counts that sum to N number at most sqrt(2 N),
    so the exact percentile works on a small table even when there are billions of keys.
    """
    by_size = counts.groupBy("n").agg(F.count(F.lit(1)).alias("keys"))
    total = F.sum(F.col("n") * F.col("keys")).cast("double")
    return by_size.agg(
        F.coalesce(F.min("n"), F.lit(0)).alias("min_n"),
        F.coalesce(F.percentile("n", F.lit(0.5), F.col("keys")), F.lit(0.0)).alias("median_n"),
        F.coalesce(F.try_divide(total, F.sum("keys").cast("double")), F.lit(0.0)).alias("mean_n"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_n"),
    )


def density(by_user: DataFrame, by_item: DataFrame) -> DataFrame:
    """Share of the user-item grid that is rated, from the two count tables; 0 when empty."""
    users = by_user.agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("ratings"))
    items = by_item.agg(F.count(F.lit(1)).alias("items"))
    grid = F.col("users").cast("double") * F.col("items")
    return _side_by_side(users, items).select(
        F.coalesce("ratings", F.lit(0)).alias("ratings"),
        "users",
        "items",
        F.coalesce(F.try_divide(F.col("ratings").cast("double"), grid), F.lit(0.0)).alias("density"),
    )


def _side_by_side(*one_row: DataFrame) -> DataFrame:
    """Several one-row results as one row."""
    stacked = one_row[0]
    for other in one_row[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def unseen_ids(pairs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct ids of ``pairs`` that ``known`` lacks."""
    return pairs.select(key).distinct().join(known.select(key), key, "left_anti")


def cold_start_counts(pairs: DataFrame, by_user: DataFrame, by_item: DataFrame) -> DataFrame:
    """Number of distinct users and items to score that training never saw."""
    users = unseen_ids(pairs, by_user, "user_id").agg(F.count(F.lit(1)).alias("unseen_users"))
    items = unseen_ids(pairs, by_item, "business_id").agg(F.count(F.lit(1)).alias("unseen_items"))
    return _side_by_side(users, items)


def ratings_profile(
    ratings: DataFrame, pairs: DataFrame, by_user: DataFrame, by_item: DataFrame
) -> DataFrame:
    """The figures above as rows ``metric, value``."""

    def rows(one_row: DataFrame, prefix: str = "") -> DataFrame:
        entries = [
            F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in one_row.columns
        ]
        return one_row.select(F.inline(F.array(*entries)))

    # one pass over the ratings gives the mean and the histogram; the rest comes from the counts
    stars = F.col("stars").cast("int")
    levels = [F.count_if(stars == s).alias(f"stars_{s}") for s in range(1, 6)]
    mean = F.coalesce(F.avg("stars"), F.lit(EMPTY_MEAN)).alias("global_mean")
    return (
        rows(ratings.agg(mean, *levels))
        .unionByName(rows(density(by_user, by_item)))
        .unionByName(rows(count_profile(by_user), "user_"))
        .unionByName(rows(count_profile(by_item), "item_"))
        .unionByName(rows(cold_start_counts(pairs, by_user, by_item)))
    )
