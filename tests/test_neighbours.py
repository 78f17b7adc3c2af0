from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starblend.operators import neighbours

RATINGS = "user_id string, business_id string, stars double"


def sample(spark, seed, users, items, share):
    """Random ratings as a frame and as a {user: {item: stars}} table."""
    rng = np.random.default_rng(seed)
    table = {}
    for u in range(users):
        for b in range(items):
            if rng.random() < share:
                table.setdefault(f"u{u:02d}", {})[f"b{b:02d}"] = float(rng.integers(1, 6))
    rows = [(u, b, s) for u, rated in table.items() for b, s in rated.items()]
    return spark.createDataFrame(rows, RATINGS), table


def pearson(table, a, b, shrink):
    both = np.array([(r[a], r[b]) for r in table.values() if a in r and b in r])
    n = len(both)
    if n < 3 or both[:, 0].std() == 0 or both[:, 1].std() == 0:
        return None
    return np.corrcoef(both.T)[0, 1] * n / (n + shrink)


def all_similarities(table, shrink):
    items = sorted({b for rated in table.values() for b in rated})
    found = {(a, b): pearson(table, a, b, shrink) for a in items for b in items if a < b}
    return {k: round(v, 9) for k, v in found.items() if v is not None}


def test_similarities_match_numpy(spark):
    ratings, table = sample(spark, 1, 25, 12, 0.5)
    expected = all_similarities(table, 5.0)
    found = {(r.item_a, r.item_b): r for r in neighbours.item_similarities(ratings, 5.0).collect()}
    assert found.keys() == expected.keys()
    for key, row in found.items():
        assert row.sim == pytest.approx(expected[key], abs=1e-9)
        assert abs(row.sim) <= row.n / (row.n + 5.0) + 1e-12


def test_too_few_raters_and_constant_items_are_absent(spark):
    rows = [(f"u{i}", "flat", 3.0) for i in range(4)]
    rows += [(f"u{i}", "a", float(1 + i)) for i in range(4)]
    rows += [(f"u{i}", "b", float(4 - i)) for i in range(4)]
    rows += [("u0", "rare", 1.0), ("u1", "rare", 5.0)]
    found = neighbours.item_similarities(spark.createDataFrame(rows, RATINGS), 5.0).collect()
    assert [(r.item_a, r.item_b) for r in found] == [("a", "b")]
    assert found[0].sim == pytest.approx(-4 / 9)


@pytest.mark.parametrize("constant", [3.1, 2.9, 1.1])
def test_constant_decimal_items_have_no_similarity(spark, constant):
    rng = np.random.default_rng(7)
    rows = [(f"u{u}", "flat", constant) for u in range(25)]
    rows += [(f"u{u}", f"b{b}", float(np.round(1 + 0.4 * rng.integers(0, 11), 1))) for u in range(25) for b in range(5)]
    rows += [(f"u{u}", "twin", s) for u, b, s in ((int(u[1:]), b, s) for u, b, s in rows) if b == "b0"]
    found = neighbours.item_similarities(spark.createDataFrame(rows, RATINGS), 0.0).collect()
    assert not [r for r in found if "flat" in (r.item_a, r.item_b)]
    assert len(found) == 15 and all(abs(r.sim) <= 1 for r in found)
    assert next(r.sim for r in found if (r.item_a, r.item_b) == ("b0", "twin")) == pytest.approx(1)


def test_a_user_with_a_thousand_items_loses_nothing(spark):
    stars = {u: {f"i{i:04d}": float(1 + (i * (u + 3) + u * i * i) % 5) for i in range(1000)} for u in range(3)}
    rows = [(f"u{u}", b, s) for u, rated in stars.items() for b, s in rated.items()]
    ratings = spark.createDataFrame(rows, RATINGS)
    heavy = neighbours.heavy_users(ratings, 130)
    assert {r["user_id"]: r["blocks"] for r in heavy.collect()} == {f"u{u}": 8 for u in range(3)}
    assert neighbours.item_pairs(ratings, heavy).count() == 3 * 1000 * 999 // 2
    one = {(r.item_a, r.item_b): (r.n, round(r.sim, 9)) for r in neighbours.item_similarities(ratings, 5.0, 0.2, heavy).collect()}
    two = {(r.item_a, r.item_b): (r.n, round(r.sim, 9)) for r in neighbours.item_similarities(ratings, 5.0, 0.2).collect()}
    assert one == two and len(one) > 1000


@pytest.mark.parametrize("block", [1, 2, 5])
def test_pairs_of_heavy_users_are_the_same_pairs(spark, block):
    ratings, _ = sample(spark, 3, 8, 9, 0.6)
    ratings = ratings.unionByName(ratings.limit(5))  # rated twice
    plain = neighbours.item_pairs(ratings)
    split = neighbours.item_pairs(ratings, neighbours.heavy_users(ratings, block))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_only_routed_targets_make_copies(spark, work, monkeypatch):
    """A list of 20 is needed once, by the one target that takes it, although 40 targets ask for its item."""
    monkeypatch.setattr(neighbours, "ROWS_PER_SPLIT", 20)
    history = [("long", f"n{i:02d}", 0.1) for i in range(60)] + [(f"u{i}", "n00", 0.2) for i in range(40)]
    history = spark.createDataFrame(history, "user_id string, neighbour string, resid double")
    weights = spark.createDataFrame([("a", f"n{i:02d}", 0.5) for i in range(20)], "item_a string, item_b string, w double")
    targets = spark.createDataFrame([("long", "a")] + [(f"u{i}", "a") for i in range(40)], "user_id string, business_id string")
    made = []

    def counted(splits):
        made.append(splits)
        return F.explode(F.sequence(F.lit(0), F.col(splits) - 1)).alias("split")

    monkeypatch.setattr(neighbours, "_every_split", counted)
    seen = []
    attach = neighbours.attach

    def watched(*args):
        out = attach(*args)
        if "splits" in out.columns and "split" not in out.columns and "by_history" not in out.columns:
            seen.append(out)
        return out

    monkeypatch.setattr(neighbours, "attach", watched)
    found = neighbours.neighbour_candidates(targets, history, weights, work)
    assert found.count() == 20 + 40
    copies = sorted(f.agg(F.sum("splits")).first()[0] for f in seen)
    assert copies == [20, 40] and len(made) == 2  # the list's 20 rows and the short histories, once each


def test_cap_takes_the_first_items_by_id(spark):
    ratings, table = sample(spark, 2, 6, 30, 0.9)
    kept = neighbours.cap_user_items(ratings, 5, "stars")
    for user, rated in table.items():
        found = [r["business_id"] for r in kept.where(F.col("user_id") == user).collect()]
        assert sorted(found) == sorted(rated)[:5]


def test_cap_is_applied_before_the_shuffle_too(spark):
    ratings, _ = sample(spark, 2, 6, 30, 0.9)
    plan = neighbours.cap_user_items(ratings, 5, "stars")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_a_hot_pair_is_summed_before_the_shuffle(spark):
    ratings, _ = sample(spark, 2, 6, 30, 0.9)
    plan = neighbours.item_similarities(ratings)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def expected_scores(table, pairs, mean, bu, bi, shrink, threshold, k, alpha, cap, gate):
    sims = all_similarities(table, shrink)
    out = []
    for u, b in pairs:
        base = float(np.clip(mean + bu.get(u, 0) + bi.get(b, 0), 1, 5))
        usable = []
        for other, stars in table.get(u, {}).items():
            sim = sims.get((min(b, other), max(b, other)))
            if other != b and sim is not None and abs(sim) >= threshold:
                resid = np.clip(stars - mean - bu.get(u, 0) - bi.get(other, 0), -cap, cap)
                usable.append((-(abs(sim) ** alpha), other, np.sign(sim) * abs(sim) ** alpha, resid))
        usable = sorted(usable)[:k]
        den = sum(abs(w) for _, _, w, _ in usable)
        if den > gate:
            base = float(np.clip(base + sum(w * r for _, _, w, r in usable) / den, 1, 5))
        out.append((base, len(usable)))
    return out


@pytest.mark.parametrize("rows_per_split", [4_000_000, 3])
@pytest.mark.parametrize("k", [120, 2])
def test_predictions_match_brute_force(spark, work, monkeypatch, rows_per_split, k):
    monkeypatch.setattr(neighbours, "ROWS_PER_SPLIT", rows_per_split)
    ratings, table = sample(spark, 5, 20, 14, 0.45)
    # one user rated everything, one item is paired with few others
    extra = [("u99", f"b{b:02d}", float(1 + b % 5)) for b in range(14)]
    table["u99"] = {b: s for _, b, s in extra}
    ratings = ratings.unionByName(spark.createDataFrame(extra, RATINGS))
    bu = {u: 0.1 * (i % 5 - 2) for i, u in enumerate(sorted(table))}
    bi = {f"b{b:02d}": 0.15 * (b % 4 - 1) for b in range(14)}
    pairs = [(u, f"b{b:02d}") for u in sorted(table) for b in range(14)]
    pairs += [("new", "b01"), ("u00", "new"), ("new", "new"), pairs[0]]
    frame = spark.createDataFrame(
        [(i, u, b) for i, (u, b) in enumerate(pairs)], "row_id int, user_id string, business_id string"
    )
    # rounded, so that equal similarities are equal in both computations
    sims = neighbours.item_similarities(ratings, 5.0).withColumn("sim", F.round("sim", 9))
    sims = work.table(sims, "sims")
    found = neighbours.cf_predict(
        frame, ratings, sims,
        spark.createDataFrame(list(bu.items()), "user_id string, bu double"),
        spark.createDataFrame(list(bi.items()), "business_id string, bi double"),
        3.2, 0.05, k, 1.1, 1.5, 0.4, work,
    ).orderBy("row_id").collect()
    expected = expected_scores(table, pairs, 3.2, bu, bi, 5.0, 0.05, k, 1.1, 1.5, 0.4)
    assert [r["row_id"] for r in found] == list(range(len(pairs)))
    assert [r["support"] for r in found] == [n for _, n in expected]
    assert [r["cf"] for r in found] == pytest.approx([s for s, _ in expected], abs=1e-9)


def test_both_ways_of_finding_neighbours_are_used(spark, work, monkeypatch):
    """Users with long histories are expanded from the item's list, others from their history."""
    history = [("long", f"n{i:02d}", 0.1) for i in range(20)] + [("short", "n00", 0.2)]
    history = spark.createDataFrame(history, "user_id string, neighbour string, resid double")
    weights = spark.createDataFrame(
        [("a", "n00", 0.5), ("a", "n01", -0.4), ("n02", "z", 0.3)],
        "item_a string, item_b string, w double",
    )
    targets = spark.createDataFrame(
        [("long", "a"), ("short", "a"), ("long", "z"), ("short", "z"), ("none", "a")],
        "user_id string, business_id string",
    )
    rows = neighbours.neighbour_candidates(targets, history, weights, work)
    found = sorted((r.user_id, r.business_id, r.neighbour, r.w, r.resid) for r in rows.collect())
    assert found == [
        ("long", "a", "n00", 0.5, 0.1), ("long", "a", "n01", -0.4, 0.1),
        ("long", "z", "n02", 0.3, 0.1), ("short", "a", "n00", 0.5, 0.2),
    ]


def test_gate_is_strict(spark):
    rows = spark.createDataFrame([(0.3, 0.6, 3.0), (0.3, 0.61, 3.0), (None, None, 3.0)],
                                 "num double, den double, base double")
    found = [r[0] for r in rows.select(neighbours.cf_score(F.col("base"), 0.6)).collect()]
    assert found == [3.0, pytest.approx(3.0 + 0.3 / 0.61), 3.0]


def test_equal_weights_are_taken_in_item_order(spark, work):
    targets = spark.createDataFrame([("u", "t")], "user_id string, business_id string")
    residuals = spark.createDataFrame(
        [("u", f"n{i}", float(i)) for i in range(5)], "user_id string, business_id string, resid double"
    )
    sims = spark.createDataFrame(
        [(f"n{i}", "t", 0.5 if i % 2 else -0.5) for i in range(5)], "item_a string, item_b string, sim double"
    )
    row = neighbours.cf_adjustments(targets, residuals, sims, work, 0.05, 2, 1.0, 9.0).first()
    assert row["num"] == pytest.approx(0.5 * 1.0 - 0.5 * 0.0) and row["support"] == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_proposals_find_every_similar_pair(spark, work, seed):
    """Users who rated nearly everything, some items twice: with and without proposals the similarities are the same."""
    rng = np.random.default_rng(seed)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(60) for i in rng.choice(40, rng.integers(1, 6), replace=False)]
    rows += [(u, i, float(rng.integers(1, 6))) for u in (100, 101, 102) for i in range(40) if rng.random() < 0.9]
    rows += [(u, 7, s) for u in (5, 102) for s in (2.0, 4.0)]
    ratings = work.table(spark.createDataFrame([(int(u), int(i), s) for u, i, s in rows], "user_id long, business_id long, stars double"), "r")
    tails = work.table(neighbours.item_tails(ratings), "tails")
    assert tails.groupBy("business_id").count().where("count > 2").isEmpty()
    assert tails.where("user_id IN (5, 102) AND business_id = 7").isEmpty()

    def found(df):
        return {(r.item_a, r.item_b): (r.n, round(r.sim, 9)) for r in df.collect()}

    pairs = neighbours.proposed_pairs(ratings, tails, work)
    assert found(neighbours.item_similarities(ratings)) == found(neighbours.item_similarities(ratings, pairs=pairs))
    assert neighbours.tails_pay(ratings, tails) in (True, False)


def test_hot_users_propose_little(spark, work):
    rows = [(u, i, float(1 + (u + i) % 5)) for u in (100, 101) for i in range(400)] + [(i % 50, i, 3.0) for i in range(400)]
    ratings = work.table(spark.createDataFrame(rows, "user_id long, business_id long, stars double"), "r")
    tails = work.table(neighbours.item_tails(ratings), "tails")
    assert neighbours.tails_pay(ratings, tails)
    assert neighbours.item_pairs(ratings).count() > 150_000
    assert neighbours.proposed_pairs(ratings, tails, work).count() < 10_000


def test_what_travels_to_an_item_is_one_row_for_each_rating(spark, monkeypatch):
    """Sums by pair are made where an item's lists lie; pairs are not shuffled."""
    monkeypatch.setattr(neighbours, "PAIRS_PER_TASK", 50)
    ratings, _ = sample(spark, 2, 6, 30, 0.9)
    plan = neighbours.item_similarities(ratings)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item_a" in plan and not re.search(r"hashpartitioning\(item_a#\d+, item_b#\d+", plan)
    lists = neighbours._item_lists(ratings, None)
    assert lists.count() <= ratings.count() and lists.agg(F.sum(F.size("items"))).first()[0] == neighbours.item_pairs(ratings).count()


@pytest.mark.parametrize("block", [None, 4])
def test_busy_items_make_the_same_pairs_in_several_tasks(spark, monkeypatch, block):
    ratings, table = sample(spark, 5, 40, 8, 0.6)
    ratings = ratings.unionByName(ratings.limit(5)).unionByName(
        spark.createDataFrame([(None, "b00", 1.0), ("u01", None, 2.0), ("u02", "b09", None), ("u03", "b09", None)], RATINGS)
    )
    heavy = neighbours.heavy_users(ratings, block)
    plain, sims = neighbours.item_pairs(ratings), neighbours.item_similarities(ratings, 5.0)
    monkeypatch.setattr(neighbours, "RATERS_PER_SPLIT", 24)
    monkeypatch.setattr(neighbours, "PAIRS_PER_TASK", 50)
    busy = neighbours.busy_items(ratings)
    assert {r["splits"] for r in busy.collect()} == {2}
    split = neighbours.item_pairs(ratings, heavy, busy)

    def rows(frame):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in frame.collect())

    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert rows(neighbours.item_similarities(ratings, 5.0, 0.0, heavy, busy=busy)) == rows(sims)


def hot_sample(spark, work):
    """Two users who rated nearly everything, sixty others, and stars that are missing."""
    rng = np.random.default_rng(5)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(60) for i in rng.choice(80, rng.integers(2, 9), replace=False)]
    rows += [(u, i, None if i % 11 == 0 else float(rng.integers(1, 6))) for u in (100, 101, 102) for i in range(80) if rng.random() < 0.9]
    rows += [(None, 3, 2.0), (4, None, 1.0), (7, 3, None), (7, 5, None)]
    rows = [(*(None if k is None else int(k) for k in r[:2]), r[2]) for r in rows]
    return work.table(spark.createDataFrame(rows, "user_id long, business_id long, stars double"), "hot")


@pytest.mark.parametrize("raters", [100_000, 10])
def test_looked_up_raters_give_the_same_similarities(spark, work, monkeypatch, raters):
    ratings = hot_sample(spark, work)
    plain = neighbours.item_similarities(ratings, 5.0)
    monkeypatch.setattr(neighbours, "RATERS_PER_SPLIT", raters)
    monkeypatch.setattr(neighbours, "tails_pay", lambda *_: True)
    found = neighbours.similarities_of(ratings, work, 5.0, block=9)

    def rows(frame):
        return {(r.item_a, r.item_b): (r.n, round(r.sim, 9)) for r in frame.collect()}

    assert len(rows(plain)) > 1000 and rows(found) == rows(plain)


def test_raters_are_looked_up_where_the_pairs_lie(spark, work, monkeypatch):
    """Proposed pairs are neither stored nor moved: their rows lie with the item's lists, and nothing is joined by pair."""
    monkeypatch.setattr(neighbours, "PAIRS_PER_TASK", 500)
    stored = []
    monkeypatch.setattr(type(work), "table", lambda self, df, name, rows=None, keep=type(work).table: stored.append(df.columns) or keep(self, df, name, rows))
    ratings = hot_sample(spark, work)
    monkeypatch.setattr(neighbours, "tails_pay", lambda *_: True)
    plan = neighbours.similarities_of(ratings, work, block=9)._jdf.queryExecution().executedPlan().toString()
    assert "looked" in plan and "hashpartitioning(item_a" in plan and not re.search(r"hashpartitioning\(item_a#\d+L?, item_b#\d+", plan)
    assert not re.search(r"hashpartitioning\([^)]*user_id#\d+L?, item_", plan) and not any("item_b" in columns for columns in stored)


def test_lists_are_made_in_tasks_of_bounded_output(spark, work, monkeypatch):
    """The tasks that make the lists are counted by what they write, not by what they read."""
    ratings, _ = sample(spark, 2, 40, 30, 0.9)
    made = neighbours.item_pairs(ratings).count()
    monkeypatch.setattr(neighbours, "PAIRS_PER_TASK", 10 * made)
    monkeypatch.setattr(neighbours, "ENTRIES_PER_TASK", made // 20)
    plan = neighbours.item_similarities(ratings)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+, 2[0-9]\), REPARTITION_BY_NUM", plan)


def test_lists_carry_short_codes(spark, monkeypatch):
    """An entry of a list is an int and a byte where ids and stars allow it, and not an id and a double."""
    made = []
    monkeypatch.setattr(neighbours, "_item_lists", lambda *given, keep=neighbours._item_lists: made.append(keep(*given)) or made[-1])
    rows = [(u, 10**12 + b, 1 + 0.4 * ((u * b) % 11)) for u in range(30) for b in range(6)]
    neighbours.item_pairs(spark.createDataFrame(rows, "user_id long, business_id long, stars double"))
    assert {"array<int>", "array<tinyint>"} <= set(dict(made[0].dtypes).values())


@pytest.mark.parametrize(
    ("apart", "levels"), [(-(2**31) + 4, 5), (2**31 - 8, neighbours.STAR_LEVELS), (2**31 - 7, neighbours.STAR_LEVELS + 1), (2**60, 7), (0, None)]
)
def test_coded_lists_make_the_same_pairs(spark, monkeypatch, apart, levels):
    """Ids far apart, negative or null, many different stars, and stars that are null or not a number."""
    monkeypatch.setattr(neighbours, "RATERS_PER_SPLIT", 9)
    items = [-7, 0, 3, None, apart]
    stars = [None, *[k / 7 for k in range((levels or 1) - 1)], float("nan") if apart > 2**31 else -1.0] if levels else [None]
    rated = [(u, b, stars[(7 * u + 3 * k) % len(stars)]) for u in range(60) for k, b in enumerate(items)]
    rated += [(0, 3, stars[-1]), (None, 0, stars[-1]), (None, 3, stars[-1])]
    ratings = spark.createDataFrame(rated, "user_id long, business_id long, stars double")
    mine = ratings.alias("x").join(ratings.alias("y"), "user_id").where("x.business_id < y.business_id").selectExpr(
        "x.business_id AS item_a", "y.business_id AS item_b", "x.stars AS a", "y.stars AS b"
    )
    for heavy in (None, neighbours.heavy_users(ratings, 2)):
        found = neighbours.item_pairs(ratings, heavy, neighbours.busy_items(ratings))
        assert found.dtypes == mine.dtypes and sorted(map(repr, found.collect())) == sorted(map(repr, mine.collect()))


def test_blocks_travel_as_lists_to_their_pairs(spark):
    """A heavy user's rows are not copied for each block: a block goes as one list to each pair of blocks, without a join."""
    ratings, _ = sample(spark, 3, 8, 9, 0.6)
    ratings = ratings.unionByName(ratings.limit(5))
    lists = neighbours._item_lists(ratings, neighbours.heavy_users(ratings, 2))
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Join[^\n]*_other", plan) and len(re.findall(r"Join (?!LeftAnti)", plan)) == 1
    assert lists.agg(F.sum(F.size("items"))).first()[0] >= neighbours.item_pairs(ratings).count()


def test_raters_of_a_pair_are_looked_up_without_lambdas(spark):
    one, other = F.struct(*[F.col(f"{c}1").alias(c) for c in neighbours._TAIL_COLUMNS]), F.struct(*[F.col(f"{c}2").alias(c) for c in neighbours._TAIL_COLUMNS])
    rows = [([7, 9], [5, 7, 9], [1.0, 2.0, None], [9, 5], [5, 9], [3.0, 4.0]), ([], [], [], [5], [5], [2.0])]
    frame = spark.createDataFrame(rows, ", ".join(f"{c}{k} array<{t}>" for k in (1, 2) for c, t in zip(neighbours._TAIL_COLUMNS, ("bigint", "bigint", "double"))))
    looked = frame.select(neighbours._looked_up(one, other).alias("looked"))
    assert "lambda" not in looked._jdf.queryExecution().optimizedPlan().toString()
    first, second = (r["looked"] for r in looked.collect())
    assert first["more"] == 2 and (first["a1"], first["b1"]) == (None, 4.0) and (first["a3"], first["b3"]) == (1.0, 3.0)
    assert first["a0"] is first["a2"] is None and second["more"] == 0
