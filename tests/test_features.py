from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from starblend.operators import features, pca
from starblend.sources import schemas


def vectors(spark, matrix):
    frame = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)],
                                  "i int, a array<double>")
    return frame.withColumn("v", array_to_vector("a"))


def scores(spark, matrix, k):
    rows = pca.pca_project(vectors(spark, matrix), "v", k, "out").orderBy("i").collect()
    return np.array([r["out"] for r in rows])


def test_pca_matches_eigenvectors_up_to_sign(spark):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 3
    found = scores(spark, matrix, 3)
    centred = matrix - matrix.mean(axis=0)
    values, axes = np.linalg.eigh(np.cov(centred.T))
    expected = centred @ axes[:, np.argsort(values)[::-1][:3]]
    assert np.abs(found) == pytest.approx(np.abs(expected), abs=1e-8)
    assert found.mean(axis=0) == pytest.approx(np.zeros(3), abs=1e-9)


def test_pca_pads_and_survives_small_inputs(spark):
    assert scores(spark, [[1.0, 2.0]], 3).tolist() == [[0.0, 0.0, 0.0]]
    wide = scores(spark, [[1.0, 2.0], [2.0, 1.0], [4.0, 4.5]], 4)
    assert wide.shape == (3, 4) and (wide[:, 2:] == 0).all() and (wide[:, 0] != 0).any()
    few = scores(spark, [[1.0, 2.0, 3.0, 4.0], [2.0, 1.0, 0.0, 5.0]], 3)
    assert (few[:, 2] == 0).all()
    assert scores(spark, [[2.0, 2.0]] * 4, 2) == pytest.approx(np.zeros((4, 2)))


def side_rows(spark, schema, rows):
    fields = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], schema).withColumn(
        "row_id", F.monotonically_increasing_id()
    )


def test_user_features(spark, work):
    rows = [{"user_id": f"u{i}", "review_count": str(i), "fans": "2", "compliment_hot": str(i * i),
             "compliment_note": str(i), "yelping_since": "2015-01-01", "elite": "2012,2013"}
            for i in range(8)]
    rows.append({"user_id": "u0", "review_count": "99"})
    found = {r["user_id"]: r for r in features.user_features(
        side_rows(spark, schemas.USERS, rows), work).collect()}
    assert len(found) == 8
    assert found["u0"]["u_log_review_count"] == pytest.approx(np.log(100))  # the last line wins
    assert found["u0"]["u_account_age"] == 2025 and found["u0"]["u_avg_stars"] == 3.5
    assert found["u3"]["u_comp_sum"] == 12 and found["u3"]["u_elite_len"] == 2
    assert list(found["u3"].asDict()) == ["user_id", *features.USER_FEATURES[:-1]]


def test_business_features(spark, work):
    rows = [{"business_id": f"b{i}", "categories": "Food, Bars" if i % 2 else "Food, , food",
             "city": f" City{i % 3} ", "state": "nv" if i < 5 else "", "hours": {"Monday": "9-5"},
             "attributes": {"RestaurantsPriceRange2": "3"}, "stars": "4.5"} for i in range(9)]
    rows.append({"business_id": "bare"})
    found = {r["business_id"]: r for r in features.business_features(
        side_rows(spark, schemas.BUSINESSES, rows), work).collect()}
    assert len(found) == 10
    assert found["b1"]["b_category_count"] == 2 and found["b1"]["b_price"] == 3
    assert found["b1"]["b_open_Mon"] == 1 and found["b1"]["b_open_Tue"] == 0
    bare = found["bare"].asDict()
    assert (bare["b_is_open"], bare["b_price"], bare["b_avg_stars"]) == (1.0, 2.0, 3.5)
    # two category terms and the unused third to sixth components
    assert found["b1"]["b_cat_pca0"] != found["b2"]["b_cat_pca0"]
    assert found["b1"]["b_cat_pca2"] == 0 == found["b1"]["b_cat_pca5"]
    assert found["b1"]["b_state_pca0"] == pytest.approx(found["b4"]["b_state_pca0"])
    assert found["b1"]["b_state_pca0"] != pytest.approx(found["b7"]["b_state_pca0"])


def test_one_business_has_zero_components(spark, work):
    rows = [{"business_id": "only", "categories": "A,B", "city": "x", "state": "y"}]
    row = features.business_features(side_rows(spark, schemas.BUSINESSES, rows), work).first().asDict()
    assert all(v == 0 for k, v in row.items() if "pca" in k)


def test_businesses_without_any_terms(spark, work):
    rows = [{"business_id": f"b{i}"} for i in range(3)]
    found = features.business_features(side_rows(spark, schemas.BUSINESSES, rows), work).collect()
    assert all(v == 0 for r in found for k, v in r.asDict().items() if "pca" in k)


def test_vocabulary_breaks_ties_by_term(spark):
    terms = spark.createDataFrame([(t,) for t in ["b", "a", "c", "c", "", "d"]], "term string")
    assert [r["term"] for r in features.vocabulary(terms, 3).collect()] == ["c", "a", "b"]


def test_bag_counts_a_repeated_term_once(spark):
    rows = spark.createDataFrame([(["a", "a", "b"],), (["c"],), ([],)], "t array<string>")
    bags = features.bag_of_terms(rows, "t", 2, "v").select(vector_to_array("v").alias("a")).collect()
    assert [r["a"] for r in bags] == [[1.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_defaults_and_order(spark):
    rows = spark.createDataFrame([("u", "b", 4.0)], "user_id string, business_id string, u_fans double")
    filled = features.fill_defaults(rows)
    assert filled.columns == ["user_id", "business_id", *features.FEATURES]
    vector = features.assemble_features(filled).first()["features"].toArray()
    assert len(vector) == 46 and vector[2] == 4.0
    nonzero = {features.FEATURES[i]: v for i, v in enumerate(vector) if v}
    assert nonzero == {"u_avg_stars": 3.5, "u_fans": 4.0, "b_avg_stars": 3.5, "b_is_open": 1.0, "b_price": 2.0}


def test_counts_without_a_business_line(spark):
    by_item = spark.createDataFrame([("b1", 3)], "business_id string, n long")
    tips = spark.createDataFrame([("b2", "4"), ("b2", "x"), ("b1", "1")], "business_id string, likes string")
    photos = spark.createDataFrame([("b3",), ("b3",)], "business_id string")
    checkins = spark.createDataFrame([("b1", {"0-1": 2}), ("b1", {"2-3": 5})],
                                     "business_id string, time map<string,bigint>")
    table = features.business_table(None, checkins, tips, photos, by_item)
    found = {r["business_id"]: r for r in features.fill_defaults(table).collect()}
    assert found["b1"]["b_log_train_count"] == pytest.approx(np.log(4))
    assert found["b1"]["b_log_checkins"] == pytest.approx(np.log(8))
    assert found["b2"]["b_log_tip_count"] == pytest.approx(np.log(3))
    assert found["b2"]["b_log_tip_likes"] == pytest.approx(np.log(5))
    assert found["b3"]["b_log_photo_count"] == pytest.approx(np.log(3))


def test_registered_feature_rows_are_stored_before_they_are_assembled(spark, tmp_path):
    """The ratings are joined once, and the columns are taken apart in a stage without the joins."""
    from starblend.plans.catalog import feature_rows

    tables = {
        "lineitem": "SELECT id AS l_orderkey, id % 7 + 1 AS l_partkey, id % 5 + 1 AS l_suppkey, 1 AS l_linenumber,"
                    " double(id % 50 + 1) AS l_quantity, TIMESTAMP '2020-01-01' AS l_shipdate FROM range(60)",
        "orders": "SELECT id AS o_orderkey, id % 12 + 1 AS o_custkey FROM range(60)",
        "customer": "SELECT id AS c_custkey, int(id % 3) AS c_nationkey, 'A' AS c_mktsegment FROM range(1, 9)",
        "part": "SELECT id AS p_partkey, 'red blue' AS p_name, 'B' AS p_brand, 'T' AS p_type, int(id % 9) AS p_size FROM range(1, 6)",
        "events": "SELECT id % 5 + 1 AS user_id, '{\"k\": 2}' AS props FROM range(20)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    found = feature_rows.assemble_features(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    kept = {(i % 12 + 1, i % 5 + 1, i) for i in range(60) if ((i % 12 + 1) * 31 + (i % 5 + 1) * 17) % 10}
    rows = found.collect()
    assert {(r.user_id, r.business_id, r.l_orderkey) for r in rows} == kept
    assert {r.b_log_checkins for r in rows} == {round(float(np.log(9)), 6)}
    assert all(r.u_avg_stars == (3.5 if r.user_id > 8 else 1.5 + r.user_id % 4) for r in rows)
