from __future__ import annotations

import numpy as np
import pytest

from starblend.operators import biases, evaluate


def grid(spark, seed=3, users=12, items=7):
    rng = np.random.default_rng(seed)
    stars = rng.integers(1, 6, (users, items)).astype(float)
    seen = rng.random((users, items)) < 0.6
    rows = [(f"u{u}", f"b{b}", stars[u, b]) for u, b in zip(*np.nonzero(seen))]
    rows = [(u, b, float(s)) for u, b, s in rows]
    return spark.createDataFrame(rows, "user_id string, business_id string, stars double"), stars, seen


def test_four_rounds_match_matrices(spark, work):
    history, stars, seen = grid(spark)
    mean, lam = 3.1, 9.0
    bu, bi = np.zeros(len(stars)), np.zeros(stars.shape[1])
    for _ in range(4):
        bu = (seen * (stars - mean - bi)).sum(axis=1) / (lam + seen.sum(axis=1))
        bi = (seen * (stars - mean - bu[:, None])).sum(axis=0) / (lam + seen.sum(axis=0))
    users, items = biases.fit_biases(history, mean, lam, 4, work)
    for row in users.collect():
        assert row["bu"] == pytest.approx(bu[int(row["user_id"][1:])], abs=1e-12)
    for row in items.collect():
        assert row["bi"] == pytest.approx(bi[int(row["business_id"][1:])], abs=1e-12)


def test_heavy_penalty_gives_the_mean(spark, work):
    history, _, _ = grid(spark)
    users, items = biases.fit_biases(history, 3.0, 1e12, 4, work)
    assert max(abs(r["bu"]) for r in users.collect()) < 1e-9
    assert max(abs(r["bi"]) for r in items.collect()) < 1e-9


def test_unknown_ids_count_zero(spark):
    bu = spark.createDataFrame([("u", 0.5)], "user_id string, bu double")
    bi = spark.createDataFrame([("b", 2.0)], "business_id string, bi double")
    pairs = spark.createDataFrame(
        [(0, "u", "b"), (1, "u", "x"), (2, "x", "b"), (3, "x", "y"), (4, "u", "b")],
        "row_id int, user_id string, business_id string",
    )
    rows = biases.bias_predict(pairs, bu, bi, 3.0).orderBy("row_id").collect()
    assert [r["bias"] for r in rows] == [5.0, 3.5, 5.0, 3.0, 5.0]


def test_reports(spark):
    rows = [(3.0, 3.0), (1.0, 2.0), (5.0, 1.0), (4.5, 2.0), (2.0, None), (1.0, 5.0), (2.9, 1.0)]
    scored = spark.createDataFrame(rows, "p double, truth double")
    errors = np.array([p - t for p, t in rows if t is not None])
    assert evaluate.rmse(scored, "p").first()["rmse"] == pytest.approx(np.sqrt((errors**2).mean()))
    found = {r["bucket"]: r["n"] for r in evaluate.error_histogram(scored, "p").collect()}
    assert found == {0: 1, 1: 2, 2: 1, 3: 0, 4: 2}
    unlabelled = scored.where("truth IS NULL")
    assert evaluate.rmse(unlabelled, "p").first()["rmse"] is None
    assert evaluate.ablation(unlabelled, ["p"]).first()["rmse"] is None


def test_borderline_errors_use_single_precision(spark):
    scored = spark.createDataFrame([(2.99999999999, 2.0)], "p double, truth double")
    found = {r["bucket"]: r["n"] for r in evaluate.error_histogram(scored, "p").collect()}
    assert found[1] == 1 and found[0] == 0


def test_rows_stored_by_user_are_not_shuffled_for_the_user_biases(spark, work, monkeypatch):
    rows = [(f"user-{u:05d}", f"b{(u * k) % 7}", float(1 + (u + k) % 5)) for u in range(4000) for k in (1, 2, 3)]
    ratings = spark.createDataFrame(rows, "user_id string, business_id string, stars double")
    ratings = work.table(ratings.dropDuplicates(["user_id", "business_id"]), "ratings")
    expected = [{r[0]: r[1] for r in side.collect()} for side in biases.fit_biases(ratings, 3.0, work=work)]
    plans, table = [], work.table

    def watched(frame, name, *more):
        if name == "user-bias":
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return table(frame, name, *more)

    monkeypatch.setattr(work, "table", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "15000")
    try:
        found = [{r[0]: r[1] for r in side.collect()} for side in biases.fit_biases(ratings, 3.0, work=work)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for one, two in zip(expected, found, strict=True):
        assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)
    assert len(plans) == 4 and all("Exchange hashpartitioning(user_id" not in p for p in plans[1:])
