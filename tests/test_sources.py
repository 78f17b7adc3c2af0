from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starblend import sources
from starblend.operators import profile


@pytest.fixture
def lines(tmp_path):
    def write(name, rows):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(rows) + "\n")
        return str(path)

    return write


def test_ratings_split_on_every_comma(spark, lines):
    path = lines("r.csv", ["user_id,business_id,stars", 'u1,"b,4.0', "u2,b2,3.5,extra", "u1,b1,5"])
    rows = sources.read_ratings(spark, path).orderBy("row_id").collect()
    assert [(r.user_id, r.business_id, r.stars) for r in rows] == [
        ("u1", '"b', 4.0), ("u2", "b2", 3.5), ("u1", "b1", 5.0),
    ]


def test_bad_star_fails(spark, lines):
    path = lines("r.csv", ["user_id,business_id,stars", "u1,b1,good"])
    with pytest.raises(PySparkException):
        sources.read_ratings(spark, path).collect()


def test_pairs_with_and_without_truth(spark, lines):
    path = lines("p.csv", ["user_id,business_id,stars", "u1,b1,4", "u1,b2", "u1,b3,4,5"])
    rows = sources.read_pairs(spark, path).orderBy("row_id").collect()
    assert [r.truth for r in rows] == [4.0, None, None]


def test_every_copy_of_the_header_goes(spark, lines, tmp_path):
    lines("d/a.csv", ["h,i,j", "u1,b1,1", "h,i,j", "u2,b1,2"])
    lines("d/b.csv", ["h,i,j", "u3,b1,3"])
    rows = sources.read_ratings(spark, str(tmp_path / "d")).orderBy("row_id").collect()
    assert [r.user_id for r in rows] == ["u1", "u2", "u3"]


def test_line_numbers_follow_many_splits(spark, lines, work):
    path = lines("big.csv", ["u,b,s"] + [f"u{i},b,3" for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = sources.read_ratings(spark, path)
        assert scan.rdd.getNumPartitions() > 5
        stored = work.table(scan, "lines")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    numbered = sources.line_numbers(stored)
    assert numbered.where(F.col("user_id") != F.concat(F.lit("u"), F.col("row_id"))).count() == 0
    assert numbered.agg(F.min("row_id"), F.max("row_id")).first()[:] == (0, 19_999)


def test_line_numbers_with_copies_of_the_header(spark, lines, tmp_path, work):
    lines("d/a.csv", ["h,i,j", "u1,b1,1", "h,i,j", "u2,b1,2"])
    lines("d/b.csv", ["u3,b1,3", "h,i,j", "u1,b1,4", "h,i,j"])
    stored = work.table(sources.read_ratings(spark, str(tmp_path / "d")), "lines")
    rows = sources.line_numbers(stored).orderBy("row_id").collect()
    assert [(r.user_id, r.row_id) for r in rows] == [("u1", 0), ("u2", 1), ("u3", 2), ("u1", 3)]
    last = profile.dedupe_ratings(sources.line_numbers(stored)).collect()
    assert {r.user_id: r.stars for r in last} == {"u1": 4.0, "u2": 2.0, "u3": 3.0}


def test_line_number_offsets_carry_no_paths_and_no_hint(spark, lines, work):
    stored = work.table(sources.read_ratings(spark, lines("p.csv", ["h,i,j", "u1,b1,1"])), "lines")
    plan = sources.line_numbers(stored)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_line_numbers_leave_other_orders_alone(spark):
    rows = spark.range(3).withColumnRenamed("id", "row_id")
    assert sources.line_numbers(rows) is rows


def test_json_without_id_fails(spark, lines):
    good = json.dumps({"user_id": "a", "review_count": 5, "compliment_hot": "x"})
    assert sources.read_users(spark, lines("u.json", [good])).first()["review_count"] == "5"
    for bad in ('{"review_count": 1}', "not json"):
        with pytest.raises(PySparkException, match="no user_id"):
            sources.read_users(spark, lines("bad.json", [good, bad])).collect()


def test_nested_json(spark, lines):
    path = lines("b.json", [
        json.dumps({"business_id": "b1", "attributes": {"RestaurantsPriceRange2": 3, "x": {"y": 1}},
                    "hours": {"Monday": "9-5"}}),
        json.dumps({"business_id": "b2", "attributes": "none", "hours": None, "city": "X"}),
    ])
    rows = {r.business_id: r for r in sources.read_businesses(spark, path).collect()}
    assert rows["b1"].attributes["RestaurantsPriceRange2"] == "3"
    assert rows["b2"].attributes is None and rows["b2"].city == "X"


def test_optional_source(spark, lines, tmp_path):
    assert sources.optional_source(sources.read_tips, spark, str(tmp_path / "no.json")) is None
    path = lines("t.json", ['{"business_id": "b", "likes": 2}'])
    assert sources.optional_source(sources.read_tips, spark, path).count() == 1


def test_predictions_keep_order_and_duplicates(spark, tmp_path):
    rows = [(i, f"u{i % 7}", 'b"1' if i % 2 else "b2", 1 + (i % 40) / 10) for i in range(500)]
    frame = spark.createDataFrame(rows, "row_id long, user_id string, business_id string, p double")
    sources.write_predictions(frame.repartition(5), str(tmp_path / "out"), "p")
    text = []
    for part in sorted(Path(tmp_path / "out").glob("part-*.csv")):
        head, *body = part.read_text().splitlines()
        assert head == "user_id,business_id,prediction"
        text += body
    assert text == [f"{u},{b},{p:.3f}" for _, u, b, p in rows]
