"""Side features of users and businesses, and the 46-column training row."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starblend.functions import (
    account_age,
    compliment_sum,
    compliments,
    elite_len,
    map_sum,
    norm_city,
    norm_state,
    open_flags,
    parse_list,
    parse_price,
    safe_float,
    safe_int,
)
from starblend.functions.profiles import REF_YEAR
from starblend.operators.pca import pca_project
from starblend.operators.profile import key_counts
from starblend.workspace import Workspace

# Vocabulary sizes (defaults, a preset may name others) and component counts.
CATEGORY_TERMS, CATEGORY_PCS = 60, 6
CITY_TERMS, CITY_PCS = 120, 5
STATE_TERMS, STATE_PCS = 25, 4
COMPLIMENT_PCS = 3

# Feature names and order.
FEATURES = [
    "u_log_review_count",
    "u_avg_stars",
    "u_fans",
    "u_comp_sum",
    "u_elite_len",
    "u_account_age",
    "u_useful",
    "u_cool",
    "u_comp_pca0",
    "u_comp_pca1",
    "u_comp_pca2",
    "b_log_review_count",
    "b_avg_stars",
    "b_is_open",
    "b_category_count",
    "b_price",
    "b_latitude",
    "b_longitude",
    "b_open_Mon",
    "b_open_Tue",
    "b_open_Wed",
    "b_open_Thu",
    "b_open_Fri",
    "b_open_Sat",
    "b_open_Sun",
    "b_cat_pca0",
    "b_cat_pca1",
    "b_cat_pca2",
    "b_cat_pca3",
    "b_cat_pca4",
    "b_cat_pca5",
    "b_city_pca0",
    "b_city_pca1",
    "b_city_pca2",
    "b_city_pca3",
    "b_city_pca4",
    "b_state_pca0",
    "b_state_pca1",
    "b_state_pca2",
    "b_state_pca3",
    "b_log_checkins",
    "b_log_tip_count",
    "b_log_tip_likes",
    "b_log_photo_count",
    "u_log_train_count",
    "b_log_train_count",
]

# Features of an unknown user or business that are not 0.
DEFAULTS = {
    "u_avg_stars": 3.5,
    "b_avg_stars": 3.5,
    "b_is_open": 1.0,
    "b_price": 2.0,
}

USER_FEATURES = [f for f in FEATURES if f.startswith("u_")]
BUSINESS_FEATURES = [f for f in FEATURES if f.startswith("b_")]


def checkin_counts(checkins: DataFrame) -> DataFrame:
    return checkins.groupBy("business_id").agg(F.sum(map_sum("time")).alias("checkins"))


def tip_counts(tips: DataFrame) -> DataFrame:
    return tips.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("tip_count"), F.sum(safe_int("likes")).alias("tip_likes")
    )


def photo_counts(photos: DataFrame) -> DataFrame:
    return key_counts(photos, "business_id").withColumnRenamed("n", "photo_count")


def vocabulary(terms: DataFrame, size: int) -> DataFrame:
    """``term, n``: the ``size`` most frequent non-blank terms, ties in term order."""
    return (
        terms.where(F.col("term") != "")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "term")
        .limit(size)
    )


def bag_of_terms(rows: DataFrame, terms: str, size: int, output: str) -> DataFrame:
    """``rows`` with a 0/1 vector over the vocabulary of the array column ``terms``.

    The vocabulary is at most ``size`` terms, so it may come to the driver.
    """
    ranked = vocabulary(rows.select(F.explode(terms).alias("term")), size).collect()
    if not ranked:
        return rows.withColumn(output, array_to_vector(F.array(F.lit(0.0))))
    model = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in ranked], inputCol=terms, outputCol=output
    )
    return model.setBinary(True).transform(rows)


def last_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The last line of each key wins, as when lines fill a lookup table in order."""
    rest = [c for c in rows.columns if c not in (key, "row_id")]
    last = F.max_by(F.struct(*rest), F.col("row_id")).alias("last")
    return rows.groupBy(key).agg(last).select(key, "last.*")


def _spread(array: str, names: list[str]) -> list:
    return [F.col(array)[i].alias(name) for i, name in enumerate(names)]


def user_columns(users: DataFrame, ref_year: int = REF_YEAR) -> DataFrame:
    """The eight plain user features and the compliment vector."""
    counted = users.withColumn("compliments", compliments())
    return counted.select(
        "user_id",
        F.log1p(safe_int("review_count").cast("double")).alias("u_log_review_count"),
        safe_float("average_stars", 3.5).alias("u_avg_stars"),
        safe_int("fans").cast("double").alias("u_fans"),
        compliment_sum("compliments").cast("double").alias("u_comp_sum"),
        elite_len("elite").cast("double").alias("u_elite_len"),
        account_age("yelping_since", ref_year).cast("double").alias("u_account_age"),
        safe_int("useful").cast("double").alias("u_useful"),
        safe_int("cool").cast("double").alias("u_cool"),
        "compliments",
        "row_id",
    )


def user_features(users: DataFrame, work: Workspace, ref_year: int = REF_YEAR) -> DataFrame:
    """``user_id`` and its eleven features; the compliment components use every line of the file."""
    plain = user_columns(users, ref_year)
    as_vector = array_to_vector(F.col("compliments").cast("array<double>"))
    staged = work.table(plain.withColumn("compliment_vector", as_vector), "user-columns")
    projected = pca_project(staged, "compliment_vector", COMPLIMENT_PCS, "pcs")
    names = [f for f in FEATURES if f.startswith("u_comp_pca")]
    kept = [f for f in USER_FEATURES if f in plain.columns]
    return last_per_key(
        projected.select("user_id", "row_id", *kept, *_spread("pcs", names)), "user_id"
    )


def business_columns(businesses: DataFrame) -> DataFrame:
    """The fourteen plain business features, and the term arrays of category, city and state."""
    cleaned = businesses.select(
        "*",
        parse_list("categories").alias("category_list"),
        norm_city("city").alias("city_term"),
        norm_state("state").alias("state_term"),
    )

    def one_term(c: str):
        return F.when(F.col(c) != "", F.array(c)).otherwise(F.array().cast("array<string>"))

    return cleaned.select(
        "business_id",
        F.log1p(safe_int("review_count").cast("double")).alias("b_log_review_count"),
        safe_float("stars", 3.5).alias("b_avg_stars"),
        safe_int("is_open", 1).cast("double").alias("b_is_open"),
        F.size("category_list").cast("double").alias("b_category_count"),
        parse_price("attributes").cast("double").alias("b_price"),
        safe_float("latitude").alias("b_latitude"),
        safe_float("longitude").alias("b_longitude"),
        *open_flags("hours"),
        F.transform("category_list", F.lower).alias("category_terms"),
        one_term("city_term").alias("city_terms"),
        one_term("state_term").alias("state_terms"),
        "row_id",
    )


def business_features(
    businesses: DataFrame,
    work: Workspace,
    category_terms: int = CATEGORY_TERMS,
    city_terms: int = CITY_TERMS,
    state_terms: int = STATE_TERMS,
) -> DataFrame:
    """``business_id`` and its 29 features from the business file; the sizes are those of the vocabularies."""
    plain = work.table(business_columns(businesses), "business-columns")
    vectors = bag_of_terms(plain, "category_terms", category_terms, "category_vector")
    vectors = bag_of_terms(vectors, "city_terms", city_terms, "city_vector")
    vectors = bag_of_terms(vectors, "state_terms", state_terms, "state_vector")
    staged = work.table(
        vectors.drop("category_terms", "city_terms", "state_terms"), "business-vectors"
    )
    projected = pca_project(staged, "category_vector", CATEGORY_PCS, "category_pcs")
    projected = pca_project(projected, "city_vector", CITY_PCS, "city_pcs")
    projected = pca_project(projected, "state_vector", STATE_PCS, "state_pcs")
    kept = [f for f in BUSINESS_FEATURES if f in plain.columns]
    return last_per_key(
        projected.select(
            "business_id",
            "row_id",
            *kept,
            *_spread("category_pcs", [f"b_cat_pca{i}" for i in range(CATEGORY_PCS)]),
            *_spread("city_pcs", [f"b_city_pca{i}" for i in range(CITY_PCS)]),
            *_spread("state_pcs", [f"b_state_pca{i}" for i in range(STATE_PCS)]),
        ),
        "business_id",
    )


def merge_by_key(spark: SparkSession, key: str, parts: list[DataFrame]) -> DataFrame:
    """One row per key of tables that each have one row per key, from a single shuffle."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    rest = [c for c in stacked.columns if c != key]
    return stacked.groupBy(key).agg(*[F.max(c).alias(c) for c in rest])


def user_table(features: DataFrame | None, by_user: DataFrame) -> DataFrame:
    """Every known user with the feature columns there are, unknown ones NULL."""
    train = by_user.select(
        "user_id", F.log1p(F.col("n").cast("double")).alias("u_log_train_count")
    )
    parts = [train] if features is None else [train, features]
    return merge_by_key(by_user.sparkSession, "user_id", parts)


def business_table(
    features: DataFrame | None,
    checkins: DataFrame | None,
    tips: DataFrame | None,
    photos: DataFrame | None,
    by_item: DataFrame,
) -> DataFrame:
    """Every known business with its features and the logs of its counts, unknown ones NULL."""

    def logs(counts: DataFrame, **names: str) -> DataFrame:
        return counts.select(
            "business_id",
            *[F.log1p(F.col(c).cast("double")).alias(name) for c, name in names.items()],
        )

    parts = [logs(by_item, n="b_log_train_count")]
    if features is not None:
        parts.append(features)
    if checkins is not None:
        parts.append(logs(checkin_counts(checkins), checkins="b_log_checkins"))
    if tips is not None:
        parts.append(
            logs(tip_counts(tips), tip_count="b_log_tip_count", tip_likes="b_log_tip_likes")
        )
    if photos is not None:
        parts.append(logs(photo_counts(photos), photo_count="b_log_photo_count"))
    return merge_by_key(by_item.sparkSession, "business_id", parts)


def fill_defaults(rows: DataFrame) -> DataFrame:
    """All 46 feature columns, in order after the others, with the default of an unknown id."""
    others = [c for c in rows.columns if c not in FEATURES]
    filled = [
        (F.coalesce(F.col(f), F.lit(DEFAULTS.get(f, 0.0))) if f in rows.columns
         else F.lit(DEFAULTS.get(f, 0.0))).alias(f)
        for f in FEATURES
    ]
    return rows.select(*others, *filled)


def assemble_features(filled: DataFrame, output: str = "features") -> DataFrame:
    """The 46 columns as one vector in their fixed order."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol=output, handleInvalid="keep")
    return assembler.transform(filled).drop(*FEATURES)
