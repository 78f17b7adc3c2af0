from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starblend.llm import voronoi

SCHEMA = "vec_id long, embedding array<float>, label int, v string"


def brute(rows, k=10, of=100):
    data = []
    for i, vec, *_ in rows:
        if vec is not None and all(x is not None and np.isfinite(x) for x in vec):
            data.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in vec]))
    dim = max((len(v) for _, v in data), default=0)
    data = [(i, v + [0] * (dim - len(v))) for i, v in data]
    out = []
    for n, (q, v) in enumerate(data):
        if q is not None and q % of == 0:
            scored = [(-sum(a * b for a, b in zip(v, w)), float("inf") if i is None else i, m, i) for m, (i, w) in enumerate(data) if m != n]
            out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, work, rows, **sizes):
    table = spark.createDataFrame(rows, SCHEMA)
    ready = table.select("vec_id", voronoi.quantized(F.col("embedding")).alias("v"), (F.col("vec_id") % 100 == 0).alias("is_query"))
    return sorted((tuple(r) for r in voronoi.top_k(ready, 10, work, **sizes).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"pivots": 5, "group_rows": 2, "block_rows": 70}])
def test_equals_brute_force(spark, work, sizes):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 0.3, (6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(0, 0.05 + (i % 3), 8)], 0, "x") for i in range(401)]
    rows += [(1000 + i, rows[7][1], 0, None) for i in range(60)]  # copies, so ties
    assert found(spark, work, rows, **sizes) == brute(rows)


def test_defined_cases(spark, work):
    ok = [0.5, -0.25]
    rows = [
        (0, ok, 1, "a"), (0, ok, 1, "a"), (100, [1.0], 1, None), (1, None, 1, None), (2, [None, 1.0], 1, None),
        (3, [float("nan"), 1.0], 1, None), (4, [float("inf"), 1.0], 1, None), (None, ok, None, None), (5, [], 1, None),
    ]
    assert found(spark, work, rows) == brute(rows)
    assert found(spark, work, []) == []
    assert found(spark, work, [(1, ok, 1, "a")]) == []


def test_large_components_are_exact(spark, work):
    rows = [(0, [1e5, 3e4], 0, ""), (1, [1e5, 3.0001e4], 0, ""), (2, [-1e5, 2e4], 0, "")]
    assert found(spark, work, rows) == brute(rows)
    big = np.array([[2**40, 3]]), np.array([[2**20, 7], [2**20 + 1, 7]])
    assert voronoi.products(*big).tolist() == [[2**60 + 21, 2**60 + 2**40 + 21]]


def ready(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    return table.select("vec_id", voronoi.quantized(F.col("embedding")).alias("v"), (F.col("vec_id") % 100 == 0).alias("is_query"))


def test_pruning_skips_vectors_and_blocks(spark, work):
    """Well separated clusters: a query meets its own cluster, in few of the blocks."""
    rng = np.random.default_rng(1)
    rows = []
    for c in range(8):
        centre = np.zeros(8)
        centre[c] = 1
        rows += [(c * 100 + i, [float(np.float32(x)) for x in centre + rng.normal(0, 0.001, 8)], 0, "") for i in range(100)]
    sizes = {"pivots": 32, "block_rows": 50}
    assert found(spark, work, rows, **sizes) == brute(rows)
    pairs, visits = voronoi.meetings(ready(spark, rows), 10, work, **sizes).shares()
    assert pairs < 0.2 and visits < 0.3


def test_nothing_is_spared_where_all_are_alike(spark, work):
    """Copies of one vector tie, so every query needs them all; they still meet in blocks."""
    rows = [(i, [0.5, 0.25], 0, "") for i in range(300)]
    met = voronoi.meetings(ready(spark, rows), 10, work, block_rows=40)
    assert met.blocks >= 8 and met.shares() == (1.0, 1.0)
    assert found(spark, work, rows, block_rows=40) == brute(rows)
