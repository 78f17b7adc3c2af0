from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starblend.operators import blend, evaluate, neighbours, skew
from starblend.plans.presets import PRESETS
from starblend.plans.recommender import MODELS, HybridRecommender, Sides, run_job
from starblend.workspace import Workspace

SMALL = {"trees": 3, "depth": 3, "rank": 4, "latent_rounds": 2}


@pytest.fixture(scope="module")
def folder(tmp_path_factory, planted):
    """Ratings, pairs and two of the five side files."""
    root = tmp_path_factory.mktemp("files")
    train, test, features = planted
    lines = [f"{r.user_id},{r.business_id},{r.stars}" for r in train.collect()]
    lines.insert(5, lines[4].rsplit(",", 1)[0] + ",1.0")
    (root / "ratings.csv").write_text("\n".join(["user_id,business_id,stars", *lines]) + "\n")
    pairs = [f"{r.user_id},{r.business_id},{r.truth}" for r in test.collect()]
    pairs += [pairs[0], "new,b001,3.0", "u001,new,2.0", "new,new,4.0"]
    (root / "pairs.csv").write_text("\n".join(["user_id,business_id,stars", *pairs]) + "\n")
    bare = [p.rsplit(",", 1)[0] for p in pairs]
    (root / "bare.csv").write_text("\n".join(["user_id,business_id", *bare]) + "\n")
    with open(root / "business.json", "w") as out:
        for r in features.collect():
            out.write(json.dumps({
                "business_id": r.business_id, "stars": 3 + r.side0, "latitude": r.side1,
                "categories": "Food, Bars" if r.side0 > 0 else "Shops", "city": "X", "state": "NV",
            }) + "\n")
    (root / "tip.json").write_text('{"business_id": "b001", "likes": 3}\n')
    return root, pairs


def test_job_from_files_to_file(spark, folder, tmp_path):
    root, pairs = folder
    model, predicted = run_job(
        spark, str(root / "ratings.csv"), str(root / "pairs.csv"), str(tmp_path / "out"), str(root),
        "aggressive", **SMALL,
    )
    with model.work:
        text = []
        for part in sorted(Path(tmp_path / "out").glob("part-*.csv")):
            text += part.read_text().splitlines()[1:]
        assert [t.rsplit(",", 1)[0] for t in text] == [p.rsplit(",", 1)[0] for p in pairs]
        assert all(1.0 <= float(t.rsplit(",", 1)[1]) <= 5.0 for t in text)
        rows = predicted.orderBy("row_id").collect()
        assert [r["row_id"] for r in rows] == list(range(len(pairs)))
        assert rows[-4]["prediction"] == rows[0]["prediction"]
        for r in rows[-3:]:
            assert r["cf"] == r["bias"] == r["latent"]
        assert rows[-1]["bias"] == pytest.approx(model.mean)
        assert model.weights != model.preset.default_weights
        reports = model.evaluate(predicted)
        found = {r["model"]: r["rmse"] for r in reports["ablation"].collect()}
        assert set(found) == {*MODELS, "prediction"}
        squares = [(r["prediction"] - r["truth"]) ** 2 for r in rows]
        assert found["prediction"] == pytest.approx((sum(squares) / len(squares)) ** 0.5)
        assert reports["errors"].agg(F.sum("n")).first()[0] == len(pairs)
        assert reports["holdout"].first()["rmse"] is not None
        weights = {r["name"]: r["weight"] for r in reports["weights"].collect()}
        assert weights == {**model.weights.of, "constant": model.weights.constant}
        figures = {r["metric"]: r["value"] for r in reports["profile"].collect()}
        assert figures["global_mean"] == pytest.approx(model.mean) and figures["users"] > 0


def test_pairs_without_truth_use_the_fixed_weights(spark, folder, tmp_path):
    root, pairs = folder
    model, predicted = run_job(
        spark, str(root / "ratings.csv"), str(root / "bare.csv"), str(tmp_path / "out"), **SMALL
    )
    with model.work:
        assert model.weights == model.preset.default_weights
        row = predicted.orderBy("row_id").first()
        total = sum(w * row[m] for m, w in model.weights.of.items()) + model.weights.constant
        assert row["prediction"] == pytest.approx(min(5.0, max(1.0, total)))
        assert predicted.count() == len(pairs)


def test_hot_keys_do_not_change_the_scores(spark, planted, monkeypatch):
    """A third of the pairs repeat one pair, a third share one user."""
    train, test, _ = planted
    rows = test.limit(60)
    one_user = test.limit(30).withColumn("user_id", F.lit("u005"))
    collected = rows.collect() + test.limit(1).collect() * 30 + one_user.collect()
    pairs = spark.createDataFrame(
        [(r.user_id, r.business_id, r.truth, i) for i, r in enumerate(collected)],
        "user_id string, business_id string, truth double, row_id long",
    )

    def scores():
        model = HybridRecommender(**SMALL).fit(train)
        with model.work:
            found = model.score(pairs).orderBy("row_id").collect()
            return [[r[m] for m in ("bias", "cf", "latent")] for r in found]

    plain = scores()
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    monkeypatch.setattr(skew, "too_large_to_broadcast", lambda dim: True)
    monkeypatch.setattr(neighbours, "ROWS_PER_SPLIT", 100)
    split = scores()
    assert len(plain) == len(split) == len(collected)
    for a, b in zip(plain, split):
        assert a[:2] == pytest.approx(b[:2], abs=1e-9)
        assert a[2] == pytest.approx(b[2], abs=0.05)


def test_blend_is_as_good_as_its_best_input(spark, planted):
    """Fitted on one half of the labelled pairs and judged on the other, with bounds that cut nothing."""
    train, test, _ = planted
    preset = PRESETS["aggressive"]
    wide = dict.fromkeys(preset.inputs, (-5.0, 5.0))
    model = HybridRecommender("aggressive", bounds=wide, trees=20, depth=3, rank=6, latent_rounds=8).fit(train)
    with model.work:
        scored = model.score(test)
        half = F.pmod(F.xxhash64("user_id", "business_id"), F.lit(2)) == 0
        weights = model.fit_blend(scored.where(half))
        held = blend.blend_predict(scored.where(~half), weights)
        errors = {r["model"]: r["rmse"] for r in evaluate.ablation(held, [*MODELS, "prediction"]).collect()}
    assert errors["prediction"] <= 1.005 * min(errors[m] for m in preset.inputs)


def test_absent_sides(spark, tmp_path):
    sides = Sides.read(spark, str(tmp_path))
    assert sides == Sides()


def test_closing_deletes_the_tables(spark):
    work = Workspace(spark)
    stored = work.table(spark.range(100), "numbers", 100)
    assert stored.count() == 100
    root = work.root.replace("file:", "")
    assert Path(root).exists()
    work.close()
    assert not Path(root).exists()


def test_written_tables_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert Workspace(spark).root.startswith(named.rstrip("/"))


def test_rows_per_file_are_bounded(spark, work):
    few = work.table(spark.range(0, 100_000, 1, 1), "few", 100_000)
    assert len(few.inputFiles()) >= 2 * spark.sparkContext.defaultParallelism
