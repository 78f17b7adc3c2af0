from __future__ import annotations

from starblend.operators import ids, profile

RATINGS = "user_id string, business_id string, stars double, row_id long"


def ratings(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RATINGS)


def test_empty_ratings(spark):
    none = ratings(spark, [])
    assert profile.global_mean(none).first()["global_mean"] == 3.5
    by_user, by_item = profile.user_counts(none), profile.item_counts(none)
    assert profile.density(by_user, by_item).first()[:] == (0, 0, 0, 0.0)
    assert profile.count_profile(by_user).first()[:] == (0, 0.0, 0.0, 0)
    assert [r["n"] for r in profile.rating_histogram(none).orderBy("stars").collect()] == [0] * 5


def test_histogram_cuts_to_whole_stars(spark):
    rows = ratings(spark, [("u", f"b{i}", s) for i, s in enumerate([1.5, 1.0, 5.0, 0.5, 6.0, 4.9])])
    found = {r["stars"]: r["n"] for r in profile.rating_histogram(rows).collect()}
    assert found == {1: 2, 2: 0, 3: 0, 4: 1, 5: 1}


def test_median_of_even_and_odd(spark):
    def median(counts):
        frame = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "k int, n long")
        return profile.count_profile(frame).first()["median_n"]

    assert median([1, 2, 4, 10]) == 3.0
    assert median([5, 1, 9]) == 5.0
    assert median([2, 2, 2, 7]) == 2.0


def test_last_duplicate_wins_and_mean_counts_all(spark):
    rows = ratings(spark, [("u", "b", 1.0), ("u", "b", 5.0), ("u", "c", 3.0), ("u", "b", 2.0)])
    found = {r["business_id"]: r["stars"] for r in profile.dedupe_ratings(rows).collect()}
    assert found == {"b": 2.0, "c": 3.0}
    assert profile.global_mean(rows).first()["global_mean"] == 2.75


def test_cold_start_counts_ids_once(spark):
    train = ratings(spark, [("u1", "b1", 3.0)])
    pairs = ratings(spark, [("u1", "b2", 1.0), ("u2", "b2", 1.0), ("u2", "b1", 1.0), ("u3", "b3", 1.0)])
    found = profile.cold_start_counts(pairs, profile.user_counts(train), profile.item_counts(train))
    assert found.first().asDict() == {"unseen_users": 2, "unseen_items": 2}


def test_dense_ids_follow_sorted_order(spark, work):
    names = [f"k{i * 7919 % 1000:03d}" for i in range(1000)]
    keys = spark.createDataFrame([(n,) for n in names], "k string").repartition(6)
    rows = ids.dense_ids(keys, "k", "i", work).orderBy("k").collect()
    assert [r["i"] for r in rows] == list(range(1000))
    assert [r["k"] for r in rows] == sorted(names)
