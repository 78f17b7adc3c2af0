from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from starblend.operators import biases, blend, boosted, evaluate, ids, latent, neighbours, profile
from starblend.operators.blend import Weights
from starblend.plans.presets import AGGRESSIVE, STABLE


def root_error(scored, column):
    return evaluate.rmse(scored, column).first()["rmse"]


@pytest.fixture(scope="module")
def fitted(spark, planted):
    from starblend.workspace import Workspace

    train, test, _ = planted
    work = Workspace(spark)
    mean = profile.global_mean(train).first()["global_mean"]
    history = work.table(profile.dedupe_ratings(train), "history")
    bu, bi = biases.fit_biases(history, mean, work=work)
    return train, test, mean, history, bu, bi, work


def test_factors_beat_the_biases(fitted):
    train, test, mean, history, bu, bi, work = fitted
    users = ids.dense_ids(profile.user_counts(train), "user_id", "u", work)
    items = ids.dense_ids(profile.item_counts(train), "business_id", "i", work)
    coded = history.join(users, "user_id").join(items, "business_id")
    residuals = neighbours.history_residuals(coded, bu, bi, mean).join(
        users, "user_id").join(items.drop("n"), "business_id")
    p, q = latent.fit_latent(residuals, 6, 8, STABLE.latent_reg, residuals.count())
    p = users.join(p, "u").select("user_id", "p")
    q = items.join(q, "i").select("business_id", "q")
    scored = latent.latent_predict(biases.bias_predict(test, bu, bi, mean), p, q, bu, bi, mean)
    assert root_error(scored, "latent") < 0.93 * root_error(scored, "bias")
    spread = test.agg(F.stddev_pop("truth")).first()[0]
    assert root_error(scored, "bias") < spread


def test_unknown_ids_fall_back_to_the_bias(spark, fitted):
    _, _, mean, _, bu, bi, _ = fitted
    p = spark.createDataFrame([("u000", [1.0, 1.0])], "user_id string, p array<double>")
    q = spark.createDataFrame([("b000", [0.3, 0.1])], "business_id string, q array<double>")
    pairs = spark.createDataFrame(
        [(0, "u000", "b000"), (1, "u000", "b001"), (2, "u001", "b000"), (3, "new", "new")],
        "row_id int, user_id string, business_id string",
    )
    scored = latent.latent_predict(biases.bias_predict(pairs, bu, bi, mean), p, q, bu, bi, mean)
    rows = scored.orderBy("row_id").collect()
    assert rows[0]["latent"] == pytest.approx(min(5.0, rows[0]["bias"] + 0.4))
    assert all(r["latent"] == r["bias"] for r in rows[1:])


def test_implicit_vectors_are_scaled_means(spark):
    history = spark.createDataFrame(
        [("u", "a"), ("u", "b"), ("u", "gone"), ("v", "b"), ("w", "gone")],
        "user_id string, business_id string",
    )
    q = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 0.0])], "business_id string, q array<double>")
    found = {r["user_id"]: r["y"] for r in latent.implicit_user_vectors(history, q, 2, 0.6).collect()}
    assert found == {"u": pytest.approx([1.2, 0.6]), "v": pytest.approx([1.8, 0.0])}


def test_solver_blocks_grow_with_the_data():
    assert latent.solver_blocks(1000) == latent.MIN_BLOCKS
    assert latent.solver_blocks(10**11) == 10**11 // latent.ROWS_PER_BLOCK


def test_trees_beat_the_mean(planted):
    train, test, features = planted
    assembler = VectorAssembler(inputCols=["side0", "side1"], outputCol="features")
    rows = assembler.transform(train.join(features, "business_id"))
    model = boosted.fit_boosted(rows, 20, 3, 0.2, 1.0, 1.0)
    scored = boosted.boosted_predict(
        assembler.transform(test.join(features, "business_id")), model
    )
    low, high = scored.agg(F.min("boosted"), F.max("boosted")).first()
    assert 1.0 <= low and high <= 5.0
    spread = test.agg(F.stddev_pop("truth")).first()[0]
    assert root_error(scored, "boosted") < 0.9 * spread


def test_tree_rows_of_a_task_are_bounded_and_the_trees_the_same(spark, work, monkeypatch):
    values = spark.range(0, 3000, 1, 1).selectExpr("double(id % 7) AS x", "double(id % 5) AS z", "double(id % 7 + id % 5) / 3 AS stars")
    rows = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(work.table(values, "tree-rows"))
    whole = boosted.fit_boosted(rows, 3, 2, 0.2, 1.0, 1.0)
    monkeypatch.setattr(boosted, "ROWS_PER_TASK", 500)
    dealt = []
    fit = boosted.GBTRegressor.fit
    monkeypatch.setattr(boosted.GBTRegressor, "fit", lambda self, rows: (dealt.append(rows), fit(self, rows))[1])
    parted = boosted.fit_boosted(rows, 3, 2, 0.2, 1.0, 1.0)
    sizes = [r["count"] for r in dealt[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 600
    scores = [[r[0] for r in boosted.boosted_predict(rows, m).orderBy("x", "z", "stars").select("boosted").collect()] for m in (whole, parted)]
    assert np.allclose(*scores, atol=1e-9)


def inputs(spark, rows=400, seed=11):
    rng = np.random.default_rng(seed)
    x = rng.uniform(1, 5, (rows, 4))
    y = np.clip(x @ [0.05, 0.2, 0.1, 0.6] + 0.1 + rng.normal(0, 0.2, rows), 1, 5)
    truth = [None if i % 7 == 0 else float(t) for i, t in enumerate(y)]
    frame = spark.createDataFrame(
        [(i, *map(float, r), t) for i, (r, t) in enumerate(zip(x, truth))],
        "row_id long, bias double, cf double, latent double, boosted double, truth double",
    )
    return frame, x, truth


@pytest.mark.parametrize("preset", [STABLE, AGGRESSIVE])
def test_blend_solves_the_ridge_equations(spark, preset):
    frame, x, truth = inputs(spark)
    columns = [["bias", "cf", "latent", "boosted"].index(m) for m in preset.inputs]
    keep = [i for i, t in enumerate(truth) if t is not None]
    a = np.hstack([x[keep][:, columns], np.ones((len(keep), 1))])
    penalty = np.diag([preset.blend_lam] * len(columns) + [0.0])
    solved = np.linalg.solve(a.T @ a + penalty, a.T @ np.array([truth[i] for i in keep]))
    moments = blend.blend_moments(frame, preset.inputs).first()
    weights = blend.fit_blend(moments, preset.inputs, preset.blend_lam, preset.bounds)
    for m, w in zip(preset.inputs, solved):
        assert weights.of[m] == pytest.approx(np.clip(w, *preset.bounds[m]))
    assert weights.constant == pytest.approx(solved[-1])


def test_weights_are_cut_but_not_the_constant(spark):
    frame, _, _ = inputs(spark)
    frame = frame.withColumn("truth", 5 - F.col("boosted"))
    moments = blend.blend_moments(frame, STABLE.inputs).first()
    weights = blend.fit_blend(moments, STABLE.inputs, STABLE.blend_lam, STABLE.bounds)
    assert weights.of["boosted"] == 0.40
    assert weights.constant == pytest.approx(5.0, abs=0.01)


def test_blend_score_is_clamped(spark):
    rows = spark.createDataFrame([(5.0, 5.0), (1.0, 1.0)], "cf double, boosted double")
    found = blend.blend_predict(rows, Weights({"cf": 0.4, "boosted": 1.0}, -0.5)).collect()
    assert [r["prediction"] for r in found] == [5.0, 1.0]


def test_first_rows(spark, monkeypatch):
    monkeypatch.setattr(blend, "BLOCK_LINES", 50)
    rows = spark.range(1000).select((F.lit(999) - F.col("id")).alias("row_id")).repartition(4)
    found = sorted(r["row_id"] for r in blend.first_rows(rows.where("row_id % 3 = 0"), 100).collect())
    assert found == list(range(0, 300, 3))
    as_struct = rows.select(F.struct((F.col("row_id") / 10).cast("int").alias("a"), "row_id").alias("row_id"))
    found = sorted(r["row_id"]["row_id"] for r in blend.first_rows(as_struct, 25).collect())
    assert found == list(range(25))
    assert blend.first_rows(rows, 5000).count() == 1000


def test_factor_gaps_match_numpy(spark):
    from starblend.plans.catalog.models import _normal_gaps

    rng = np.random.default_rng(3)
    p, q, reg = rng.normal(size=(6, 4)), rng.normal(size=(5, 4)), 0.2
    rows = [(u, i, float(rng.normal())) for u in range(6) for i in range(5) if rng.random() < 0.7 or i == 0]
    found = _normal_gaps(
        spark.createDataFrame(rows, "u int, i int, resid double"),
        spark.createDataFrame([(u, p[u].tolist()) for u in range(6)], "u int, p array<float>"),
        spark.createDataFrame([(i, q[i].tolist()) for i in range(5)], "i int, q array<float>"), reg,
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan  # one row for each rating, not one for each rating and factor
    gaps = {r["user_id"]: r["gap"] for r in found.collect()}
    assert len(gaps) == 6
    for u in range(6):
        mine = [(i, r) for v, i, r in rows if v == u]
        left = sum(q[i] * (p[u] @ q[i] - r) for i, r in mine) + reg * len(mine) * p[u]
        right = sum(q[i] * r for i, r in mine)
        assert gaps[u] == pytest.approx(np.linalg.norm(left) / np.linalg.norm(right), abs=0.006)


def test_queries_join_the_ratings_once(spark, tmp_path, monkeypatch):
    from starblend.plans.catalog import io, models

    spark.range(60).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(300).selectExpr(
        "id % 60 AS l_orderkey", "id % 11 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 6 AS INT) AS l_linenumber",
        "CAST(1 + id % 50 AS DOUBLE) AS l_quantity", "timestamp '2020-01-01' AS l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen, train_rows = [], io.train_rows
    monkeypatch.setattr(io, "train_rows", lambda ratings: seen.append(ratings) or train_rows(ratings))
    assert io.write_predictions(spark, str(tmp_path)).count() > 0
    for rows in (*seen, models._Fitted(spark, str(tmp_path)).test):
        assert rows.inputFiles() and not any("lineitem" in f for f in rows.inputFiles())
