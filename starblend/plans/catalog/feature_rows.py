"""Side features and the 46-column row."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from starblend.functions.profiles import COMPLIMENTS, DAYS
from starblend.operators import features, pca, profile
from starblend.plans import tables
from starblend.plans.catalog.registry import query, r6, ratings_sql, rounded, space, sql_r6

_TOTAL = " + ".join(
    f"(c_custkey * {i + 1} + c_nationkey) % {i + 5}" for i in range(len(COMPLIMENTS))
)

USERS_SQL = f"""users AS (
  SELECT c_custkey AS user_id,
    {sql_r6("ln(1 + c_custkey % 40)")} AS u_log_review_count,
    CAST(CASE WHEN c_custkey % 9 = 0 THEN 3.5 ELSE 1.5 + c_custkey % 4 END AS DOUBLE) AS u_avg_stars,
    CAST(c_nationkey AS DOUBLE) AS u_fans,
    CAST({_TOTAL} AS DOUBLE) AS u_comp_sum,
    CAST(CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS u_elite_len,
    CAST(CASE WHEN c_custkey % 7 = 0 THEN 2025 ELSE 25 - c_custkey % 20 END AS DOUBLE) AS u_account_age,
    CAST(c_custkey % 3 AS DOUBLE) AS u_useful,
    CAST(c_custkey % 6 AS DOUBLE) AS u_cool
  FROM customer)"""

BUSINESSES_SQL = f"""businesses AS (
  SELECT p_partkey AS business_id,
    {sql_r6("ln(1 + p_partkey % 50)")} AS b_log_review_count,
    CAST(1.5 + p_size % 4 AS DOUBLE) AS b_avg_stars,
    CAST(CASE WHEN p_partkey % 5 > 0 THEN p_partkey % 2 ELSE 1 END AS DOUBLE) AS b_is_open,
    CAST(CASE WHEN p_partkey % 8 > 0 THEN len(string_split(p_name, ' ')) ELSE 0 END AS DOUBLE) AS b_category_count,
    CAST(CASE WHEN p_partkey % 4 > 0 THEN least(4, p_size % 7) ELSE 2 END AS DOUBLE) AS b_price,
    CAST(p_size AS DOUBLE) AS b_latitude,
    CAST(-p_size - 0.25 AS DOUBLE) AS b_longitude,
    {", ".join(f"CAST(CASE WHEN (p_partkey + {d}) % 3 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS b_open_{day[:3]}"
               for d, day in enumerate(DAYS))}
  FROM part)"""


@query(f"WITH {USERS_SQL} SELECT * FROM users")
def user_columns(spark, sf):
    found = features.user_columns(tables.side_users(spark, sf)).drop("compliments", "row_id")
    return rounded(found, "u_log_review_count")


@query(f"WITH {BUSINESSES_SQL} SELECT * FROM businesses")
def business_columns(spark, sf):
    found = features.business_columns(tables.side_businesses(spark, sf))
    found = found.drop("category_terms", "city_terms", "state_terms", "row_id")
    return rounded(found, "b_log_review_count")


def _score_gaps(rows, work, vector, scores):
    """``rows`` with a column for each of ``scores``: how far it is from being an eigenvector's score, to 4 places.

    For an eigenvector v of the covariance of x, its score s = x.v (centred) has cov(x, s) = var(s) v.  So
    ``s - (x - mean) . cov(x, s) / var(s)`` is 0, also where s itself is 0.
    """
    staged = work.table(rows.withColumn("_x", vector_to_array(vector)).drop(vector), "scores")
    k = len(scores)
    sums = (
        staged.select(F.posexplode("_x").alias("d", "x"), *scores).groupBy("d")
        .agg(F.avg("x").alias("m"), *[F.covar_samp("x", s).alias(f"c{j}") for j, s in enumerate(scores)])
        .orderBy("d").collect()
    )  # one row for each dimension, at most the size of a vocabulary
    moments = staged.agg(*[F.var_samp(s).alias(f"v{j}") for j, s in enumerate(scores)], *[F.avg(s).alias(f"a{j}") for j, s in enumerate(scores)]).first()
    variances = [moments[f"v{j}"] or 0.0 for j in range(k)]
    out = staged
    for j, s in enumerate(scores):
        if variances[j] < 1e-9:
            gap = F.col(s) - F.lit(moments[f"a{j}"] or 0.0)
        else:
            centred = F.zip_with("_x", F.array(*[F.lit(r["m"]) for r in sums]), lambda x, m: x - m)
            along = F.zip_with(centred, F.array(*[F.lit(r[f"c{j}"] / variances[j]) for r in sums]), lambda x, v: x * v)
            total = F.aggregate(along, F.lit(0.0), lambda acc, x: acc + x)
            gap = F.col(s) - F.lit(moments[f"a{j}"]) - total
        out = out.withColumn(s, F.round(gap, 4) + F.lit(0.0))
    falling = all(a >= b - 1e-9 for a, b in zip(variances, variances[1:]))
    return out.drop("_x").withColumn("falling", F.lit(falling))


def _zeros(names) -> str:
    return ", ".join(f"CAST(0 AS DOUBLE) AS {n}" for n in names)


_USER_SCORES = [f for f in features.FEATURES if f.startswith("u_comp_pca")]


@query(f"WITH {USERS_SQL} SELECT *, {_zeros(_USER_SCORES)}, TRUE AS falling FROM users")
def user_features(spark, sf):
    """The plain features, and for each component score how far it is from solving the eigen equation."""
    work = space(spark)
    users = tables.side_users(spark, sf)
    found = features.user_features(users, work)
    vector = array_to_vector(F.col("compliments").cast("array<double>")).alias("x")
    rows = found.join(features.user_columns(users).select("user_id", vector), "user_id")
    return rounded(_score_gaps(rows, work, "x", _USER_SCORES), "u_log_review_count")


_BUSINESS_SCORES = {
    "category_terms": [f"b_cat_pca{i}" for i in range(features.CATEGORY_PCS)],
    "city_terms": [f"b_city_pca{i}" for i in range(features.CITY_PCS)],
    "state_terms": [f"b_state_pca{i}" for i in range(features.STATE_PCS)],
}
_SIZES = {"category_terms": features.CATEGORY_TERMS, "city_terms": features.CITY_TERMS, "state_terms": features.STATE_TERMS}


@query(f"""WITH {BUSINESSES_SQL}
SELECT *, {", ".join(_zeros(names) for names in _BUSINESS_SCORES.values())}, TRUE AS falling FROM businesses""")
def business_features(spark, sf):
    """The plain features, and for each component score how far it is from solving the eigen equation."""
    work = space(spark)
    businesses = tables.side_businesses(spark, sf)
    out = work.table(features.business_features(businesses, work).withColumn("falling", F.lit(True)), "features")
    columns = work.table(features.business_columns(businesses), "columns")
    for terms, names in _BUSINESS_SCORES.items():
        bags = features.bag_of_terms(columns, terms, _SIZES[terms], "x").select("business_id", "x")
        rows = out.withColumnRenamed("falling", "before").join(bags, "business_id")
        out = _score_gaps(rows, work, "x", names).withColumn("falling", F.col("falling") & F.col("before")).drop("before")
    return rounded(out, "b_log_review_count")


@query("""
SELECT user_id AS business_id, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS checkins
FROM events GROUP BY user_id""")
def checkin_counts(spark, sf):
    return features.checkin_counts(tables.side_checkins(spark, sf))


@query("""
SELECT l_suppkey AS business_id, count(*) AS tip_count, CAST(sum(l_linenumber) AS BIGINT) AS tip_likes
FROM lineitem GROUP BY l_suppkey""")
def tip_counts(spark, sf):
    return features.tip_counts(tables.side_tips(spark, sf))


@query("""
SELECT l_partkey AS business_id, count(*) AS photo_count FROM lineitem GROUP BY l_partkey""")
def photo_counts(spark, sf):
    return features.photo_counts(tables.side_photos(spark, sf))


@query("""
SELECT term, count(*) AS n FROM (
  SELECT lower(unnest(string_split(p_name, ' '))) AS term FROM part WHERE p_partkey % 8 > 0)
GROUP BY term ORDER BY n DESC, term LIMIT 60""")
def vocabulary_categories(spark, sf):
    columns = features.business_columns(tables.side_businesses(spark, sf))
    terms = columns.select(F.explode("category_terms").alias("term"))
    return features.vocabulary(terms, features.CATEGORY_TERMS)


@query("""
SELECT term, count(*) AS n FROM (
  SELECT lower(unnest(string_split(p_name, ' '))) AS term FROM part WHERE p_partkey % 8 > 0)
GROUP BY term ORDER BY n DESC, term LIMIT 5""")
def vocabulary_limited(spark, sf):
    """More terms than the vocabulary holds: the most frequent stay, ties in term order."""
    columns = features.business_columns(tables.side_businesses(spark, sf))
    return features.vocabulary(columns.select(F.explode("category_terms").alias("term")), 5)


@query("""
SELECT lower(p_brand) AS term, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, term LIMIT 120""")
def vocabulary_cities(spark, sf):
    columns = features.business_columns(tables.side_businesses(spark, sf))
    return features.vocabulary(columns.select(F.explode("city_terms").alias("term")), features.CITY_TERMS)


@query("""
SELECT upper(p_type) AS term, count(*) AS n FROM part WHERE p_partkey % 6 > 0
GROUP BY 1 ORDER BY n DESC, term LIMIT 25""")
def vocabulary_states(spark, sf):
    columns = features.business_columns(tables.side_businesses(spark, sf))
    return features.vocabulary(columns.select(F.explode("state_terms").alias("term")), features.STATE_TERMS)


@query("""
WITH vocab AS (
  SELECT term FROM (
    SELECT lower(unnest(string_split(p_name, ' '))) AS term FROM part WHERE p_partkey % 8 > 0)
  GROUP BY term ORDER BY count(*) DESC, term LIMIT 60),
terms AS (
  SELECT DISTINCT p_partkey, lower(unnest(string_split(p_name, ' '))) AS term
  FROM part WHERE p_partkey % 8 > 0)
SELECT p_partkey AS business_id, count(vocab.term) AS terms
FROM part LEFT JOIN terms USING (p_partkey) LEFT JOIN vocab USING (term) GROUP BY p_partkey""")
def bag_of_terms(spark, sf):
    """Number of vocabulary terms each business has, repeats counted once."""
    columns = features.business_columns(tables.side_businesses(spark, sf))
    bags = features.bag_of_terms(columns, "category_terms", features.CATEGORY_TERMS, "bag")
    total = F.aggregate(vector_to_array("bag"), F.lit(0.0), lambda acc, x: acc + x)
    return bags.select("business_id", total.cast("bigint").alias("terms"))


@query("""
WITH x AS (SELECT c_custkey, c_acctbal / 1000 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer),
s AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM x),
e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l0,
             (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS l1 FROM s)
SELECT c_custkey,
  round(pow((x - mx) * b + (y - my) * (l0 - a), 2) / (b * b + pow(l0 - a, 2)), 4) AS pc0_squared,
  round(pow((x - mx) * b + (y - my) * (l1 - a), 2) / (b * b + pow(l1 - a, 2)), 4) AS pc1_squared,
  CAST(0 AS DOUBLE) AS pc2_squared
FROM x, e""")
def pca_project(spark, sf):
    """Two features, three components asked: squares, as the sign of a component is open."""
    rows = tables.load(spark, sf, "customer").select(
        "c_custkey",
        array_to_vector(F.array(F.col("c_acctbal") / 1000, F.col("c_nationkey").cast("double"))).alias("v"),
    )
    found = pca.pca_project(rows, "v", 3, "pcs")
    return found.select(
        "c_custkey",
        *[(F.round(F.pow(F.col("pcs")[i], 2.0), 4) + 0.0).alias(f"pc{i}_squared") for i in range(3)],
    )


def _feature_tables(spark, sf, work):
    """The ratings, joined and stored once, and user and business tables without component scores."""
    line = F.struct("row_id.l_orderkey", "row_id.l_linenumber").alias("row_id")
    ratings = work.table(tables.rating_rows(spark, sf).select("user_id", "business_id", "stars", line), "ratings")
    train = tables.train_rows(ratings)
    users = features.user_columns(tables.side_users(spark, sf)).drop("compliments", "row_id")
    # every tenth customer and part is missing from its file: unknown ids take the defaults
    users = users.where(F.col("user_id") % 10 > 0)
    businesses = features.business_columns(tables.side_businesses(spark, sf)).drop(
        "category_terms", "city_terms", "state_terms", "row_id"
    )
    businesses = businesses.where(F.col("business_id") % 10 > 0)
    users = features.user_table(users, profile.user_counts(train))
    businesses = features.business_table(
        businesses, tables.side_checkins(spark, sf), tables.side_tips(spark, sf),
        tables.side_photos(spark, sf), profile.item_counts(train),
    )
    return ratings, users, businesses


def _feature_sql(rows: str) -> str:
    columns = []
    for f in features.FEATURES:
        default = features.DEFAULTS.get(f, 0.0)
        if "pca" in f:
            columns.append(f"CAST(0 AS DOUBLE) AS {f}")
        elif f.startswith("u_log_train") or f.startswith("b_log_") and f != "b_log_review_count":
            source = {
                "u_log_train_count": "un", "b_log_train_count": "bn", "b_log_checkins": "checkins",
                "b_log_tip_count": "tip_count", "b_log_tip_likes": "tip_likes",
                "b_log_photo_count": "photo_count",
            }[f]
            columns.append(f"{sql_r6(f'ln(1 + coalesce({source}, 0))')} AS {f}")
        else:
            columns.append(f"coalesce({f}, CAST({default} AS DOUBLE)) AS {f}")
    return f"""WITH {ratings_sql()}, {USERS_SQL}, {BUSINESSES_SQL},
uc AS (SELECT user_id, count(*) AS un FROM train GROUP BY user_id),
bc AS (SELECT business_id, count(*) AS bn FROM train GROUP BY business_id),
ch AS (SELECT user_id AS business_id, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS checkins
       FROM events GROUP BY user_id),
ti AS (SELECT l_suppkey AS business_id, count(*) AS tip_count, sum(l_linenumber) AS tip_likes
       FROM lineitem GROUP BY l_suppkey),
ph AS (SELECT l_partkey AS business_id, count(*) AS photo_count FROM lineitem GROUP BY l_partkey)
SELECT r.user_id, r.business_id, l_orderkey, l_linenumber, {", ".join(columns)}
FROM {rows} r
LEFT JOIN (SELECT * FROM users WHERE user_id % 10 > 0) USING (user_id)
LEFT JOIN (SELECT * FROM businesses WHERE business_id % 10 > 0) USING (business_id)
LEFT JOIN uc USING (user_id) LEFT JOIN bc USING (business_id) LEFT JOIN ch USING (business_id)
LEFT JOIN ti USING (business_id) LEFT JOIN ph USING (business_id)"""


_LOGS = [f for f in features.FEATURES if "_log_" in f]


@query(_feature_sql("test"))
def fill_defaults(spark, sf):
    """Feature columns of the held-out pairs."""
    ratings, users, businesses = _feature_tables(spark, sf, space(spark))
    pairs = tables.test_rows(ratings).select(
        "user_id", "business_id", "row_id.l_orderkey", "row_id.l_linenumber"
    )
    joined = pairs.join(users, "user_id", "left").join(businesses, "business_id", "left")
    return rounded(features.fill_defaults(joined), *_LOGS)


@query(_feature_sql("train"))
def assemble_features(spark, sf):
    """The feature vector of the training rows, taken apart again by position.

    As in the pipeline the columns are stored and assembled from there: in one stage with the join, the code for all
    columns gets too long to be compiled, and a row takes several times as long.
    """
    work = space(spark)
    ratings, users, businesses = _feature_tables(spark, sf, work)
    rows = tables.train_rows(ratings).select("user_id", "business_id", "row_id.l_orderkey", "row_id.l_linenumber")
    joined = rows.join(users, "user_id", "left").join(businesses, "business_id", "left")
    filled = work.table(features.fill_defaults(joined), "train-features")
    vectors = features.assemble_features(filled).withColumn(
        "a", vector_to_array("features")
    )
    columns = [
        (r6(F.col("a")[i]) if f in _LOGS else F.col("a")[i]).alias(f)
        for i, f in enumerate(features.FEATURES)
    ]
    return vectors.select("user_id", "business_id", "l_orderkey", "l_linenumber", *columns)
