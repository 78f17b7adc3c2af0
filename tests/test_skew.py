from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starblend.operators import biases, skew


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of the rows carry one key, another key is unknown, the rest are spread."""
    fact = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
    ).cache()
    dim = fact.select("k").distinct().dropna().where("k <> 'k7'").withColumn("v", F.xxhash64("k"))
    return fact, dim.cache()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_hot_path_gives_the_plain_join(lopsided, how):
    fact, dim = lopsided
    counts = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(counts, "k", 9000, hot_rows=1000)
    assert [r["k"] for r in hot.collect()] == ["hot"]
    split = skew.attach(fact, dim, "k", hot, how)
    plain = fact.join(dim, "k", how)
    assert sorted(split.select(plain.columns).collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_hot_rows_are_not_shuffled(spark, lopsided):
    fact, dim = lopsided
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        hot = skew.hot_keys(counts, "k", 9000, hot_rows=1000)
        rows = skew.KeyedRows(fact, "k", hot)
        plan = rows.hot_rows.join(F.broadcast(dim), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan


def test_number_of_hot_keys_is_bounded(spark):
    counts = spark.range(1000).selectExpr("id AS k", "10 AS n")
    assert skew.hot_keys(counts, "k", 10_000) is None
    total = 10 * skew.MAX_HOT_KEYS * 100
    assert skew.hot_keys(counts, "k", total, hot_rows=1) is None


def test_biases_with_kept_layout_and_hot_keys(spark, work):
    history = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 97 END AS user_id", "id AS business_id",
        "CAST(1 + id * 7 % 5 AS DOUBLE) AS stars",
    ).withColumn("business_id", F.col("business_id") % 61).dropDuplicates(["user_id", "business_id"])
    history = work.table(history, "history")
    plain = biases.fit_biases(history, 3.0, work=work)
    counts = history.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(counts, "user_id", history.count(), hot_rows=50)
    assert hot is not None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laid_out = biases.fit_biases(
            history, 3.0, work=work, hot_users=hot, rows=history.count()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for a, b, key in zip(plain, laid_out, ("user_id", "business_id")):
        left, right = ({r[0]: r[1] for r in t.orderBy(key).collect()} for t in (a, b))
        assert left.keys() == right.keys()
        assert [left[k] for k in left] == pytest.approx([right[k] for k in left])


def test_kept_layout_moves_only_the_small_side(spark, work):
    fact = work.table(spark.range(5000).selectExpr("id % 50 AS k", "id AS x"), "fact")
    dim = work.table(spark.range(50).selectExpr("id AS k", "id * 2 AS y"), "dim")
    small = skew.KeyedRows(fact, "k", work=work, rows=5000)
    assert small.attach(dim).count() == 5000 and small._table is None  # fits a broadcast: nothing is stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = skew.KeyedRows(fact, "k", work=work, rows=5000)
        joined = rows.attach(dim)
        assert joined.count() == 5000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        rows.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "Bucketed: true" in plan
    large_side = plan[plan.index("SortMergeJoin"):plan.index("Bucketed: true")]
    assert "Exchange" not in large_side


def test_hot_by_counts_nothing_more_where_no_key_is_hot(spark):
    counts = spark.range(100).selectExpr("id AS k", "id AS n")
    assert skew.hot_by(counts, "k") is None
    assert skew.hot_by(counts.limit(0), "k") is None
