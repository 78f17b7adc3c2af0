from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starblend import functions as S


def one_column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


NUMBERS = ["3", "3.7", " 3 ", "None", "", "inf", "nan", "1e3", "-2.9", "1_000", None, "3d", "1.5f", "+7"]


def test_safe_int(spark):
    found = one_column(spark, NUMBERS, "string", S.safe_int)
    assert found == [3, 3, 3, 0, 0, 0, 0, 1000, -2, 1000, 0, 0, 0, 7]
    assert one_column(spark, ["x"], "string", lambda c: S.safe_int(c, 9)) == [9]


def test_safe_float(spark):
    found = one_column(spark, NUMBERS, "string", lambda c: S.safe_float(c, 0.5))
    assert math.isnan(found.pop(6))
    assert found == [3.0, 3.7, 3.0, 0.5, 0.5, math.inf, 1000.0, -2.9, 1000.0, 0.5, 0.5, 0.5, 7.0]


def test_year_and_age(spark):
    dates = ["2010-01-02", "", None, "abc", "2031-05-01", "2010.5-1", " 2012 "]
    assert one_column(spark, dates, "string", S.parse_year) == [2010, 0, 0, 0, 2031, 0, 2012]
    ages = one_column(spark, dates[:5], "string", S.account_age)
    assert ages == [15, 2025, 2025, 2025, 0]
    assert one_column(spark, ["2010-1"], "string", lambda c: S.account_age(c, 2020)) == [10]


def test_lists(spark):
    values = ["A, b,, C ", "", None, "a,A", "\tx ,\n"]
    assert one_column(spark, values, "string", S.parse_list) == [
        ["A", "b", "C"], [], [], ["a", "A"], ["x"],
    ]
    years = ["2012,2013", "None", None, "", " , 2014"]
    assert one_column(spark, years, "string", S.elite_len) == [2, 0, 0, 0, 1]


def test_price(spark):
    key = "RestaurantsPriceRange2"
    maps = [{}, None, {key: "2"}, {key: "9"}, {key: "-1"}, {key: "x"}, {key: "3.9"}, {key: None}]
    assert one_column(spark, maps, "map<string,string>", S.parse_price) == [2, 2, 2, 4, 0, 2, 3, 2]


def test_open_flags(spark):
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    maps = [{d: "9-5" for d in days}, {}, None, {d: "" for d in days}, {d: "None" for d in days},
            {"Monday": "9-5", "Sunday": None}]
    flags = one_column(spark, maps, "map<string,string>", lambda c: F.array(*S.open_flags(c)))
    assert flags[0] == [1.0] * 7
    assert flags[1] == flags[2] == flags[3] == flags[4] == [0.0] * 7
    assert flags[5] == [1.0] + [0.0] * 6


def test_maps_and_places(spark):
    maps = [{"a": 2, "b": 3}, {}, None, {"a": None, "b": 1}]
    assert one_column(spark, maps, "map<string,bigint>", S.map_sum) == [5, 0, 0, 1]
    assert one_column(spark, [" Las Vegas ", None], "string", S.norm_city) == ["las vegas", ""]
    assert one_column(spark, [" nv", None], "string", S.norm_state) == ["NV", ""]


def test_compliments(spark):
    from starblend.functions.profiles import COMPLIMENTS

    frame = spark.createDataFrame(
        [tuple(str(i) for i in range(11)), ("x",) + (None,) * 10],
        ", ".join(f"{c} string" for c in COMPLIMENTS),
    )
    rows = frame.select(S.compliments().alias("v")).select("v", S.compliment_sum("v").alias("s"))
    assert [r["s"] for r in rows.collect()] == [55, 0]
    assert rows.first()["v"] == list(range(11))


def test_clamp_keeps_null(spark):
    assert one_column(spark, [0.5, 3.0, 7.0, None], "double", S.clamp) == [1.0, 3.0, 5.0, None]
    assert one_column(spark, [-9.0, 1.0, 9.0], "double", lambda c: S.winsorise(c, 2.4)) == [-2.4, 1.0, 2.4]


def test_signed_power(spark):
    found = one_column(spark, [-0.5, 0.0, 0.5], "double", lambda c: S.signed_power(c, 1.1))
    assert found == pytest.approx([-(0.5**1.1), 0.0, 0.5**1.1])


def test_fix_width(spark):
    arrays = [[1.0], [1.0, 2.0, 3.0, 4.0], [], None]
    assert one_column(spark, arrays, "array<double>", lambda c: S.fix_width(c, 3)) == [
        [1.0, 0.0, 0.0], [1.0, 2.0, 3.0], [0.0] * 3, [0.0] * 3,
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(1, 5), min_size=200, max_size=400))
def test_three_decimals_rounds_the_binary_value(spark, values):
    values = values + [1.0, 5.0, 1.0625, 3.1875, 1.0005, 2.0005, 4.9995]
    found = one_column(spark, values, "double", S.three_decimals)
    assert found == [f"{v:.3f}" for v in values]
