"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors and queries are grouped by their nearest pivot.  One more coordinate, ``sqrt(M^2 - |x|^2)`` for
data and 0 for queries, makes the order by inner product the order by Euclidean distance, so the triangle
inequality holds.  Per cell a summary keeps the radius and the k + 1 smallest distances to the pivot.  From
the summaries follows, for each cell of queries, a radius that surely holds k neighbours; a first search of
each query among at most one block of its own cell makes that radius smaller.  The radius gives the smallest pivot
distance that a vector of a data cell must have to matter.  Only those vectors travel to a group of query cells, in
blocks made of whole cells or of parts of one, and a query travels only to blocks of cells that its group needs.
Every block gives its best k with exact integer scores.  How many groups there are is chosen from histograms
of the distances: many where the bounds keep cells apart, one where they spare nothing.

Defined cases: a vector that is null, or holds a null or a non-finite component, takes no part.  Shorter
vectors count as filled up with zeros.  A null id sorts last among equal scores and is never a query's own
row.  Every row is a row of its own, also if it repeats.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starblend.workspace import Workspace

RESULT = "query_uid long, query_id long, vec_id long, uid long, score long"
LONG_MAX = 2**63 - 1
BINS = 64  # of the distance histograms


def quantized(vector: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of each component as a long; null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as int64, filled up with zeros."""
    rows = [np.asarray(x, dtype=np.int64) for x in column]
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _distances(points: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    a, b = np.c_[points.astype(float), extra], np.c_[pivots.astype(float), pivot_extra]
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floats are used only where every partial sum fits 53 bits."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries.astype(float) @ data.astype(float).T).astype(np.int64)
    exact = queries.astype(object) @ data.astype(object).T
    return np.clip(exact, -LONG_MAX - 1, LONG_MAX).astype(np.int64)


def _best(queries: pd.DataFrame, data: pd.DataFrame, k: int, dim: int) -> pd.DataFrame:
    """The k best rows of one block for each query, ties to the smaller id."""
    out = []
    if len(queries) and len(data):
        ids = data["vec_id"].to_numpy(dtype=object)
        order_id = np.array([LONG_MAX if x is None or x != x else int(x) for x in ids], dtype=np.int64)
        uids, x = data["uid"].to_numpy(np.int64), _matrix(data["v"], dim)
        for lo in range(0, len(queries), 128):
            part = queries.iloc[lo : lo + 128]
            scores = products(_matrix(part["v"], dim), x)
            for q, row in zip(part.itertuples(), scores, strict=True):
                others = np.flatnonzero(uids != q.uid)
                if len(others) > k:
                    own = row[others]
                    least = np.partition(own, len(own) - k)[len(own) - k]
                    others = others[own >= least]
                others = others[np.lexsort((uids[others], order_id[others], -row[others]))][:k]
                out += [(q.uid, q.vec_id, ids[i], uids[i], row[i]) for i in others]
    frame = pd.DataFrame(out, columns=["query_uid", "query_id", "vec_id", "uid", "score"])
    frame["vec_id"] = frame["vec_id"].map(lambda v: None if v is None or v != v else int(v)).astype("Int64")
    return frame.astype({"query_uid": "int64", "query_id": "int64", "uid": "int64", "score": "int64"})


@dataclass
class Meetings:
    """Which queries meet which vectors: both with ``grp, part, block, uid, vec_id, v``."""

    questions: DataFrame
    routed: DataFrame
    rows: int
    asked: int
    blocks: int
    dim: int

    def shares(self) -> tuple[float, float]:
        """The share of all (query, vector) and of all (query, block) pairs that meet."""
        keys = ["grp", "part", "block"]
        asked = self.questions.groupBy(*keys).agg(F.count("*").alias("q"))
        met = asked.join(self.routed.groupBy(*keys).agg(F.count("*").alias("d")), keys, "left")
        found = met.agg(F.sum(F.col("q") * F.coalesce("d", F.lit(0))).alias("pairs"), F.sum("q").alias("visits")).first()
        return (found["pairs"] or 0) / (self.asked * self.rows), (found["visits"] or 0) / (self.asked * self.blocks)


def _blocks(counts: np.ndarray, between: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of each cell: small cells share one with the cells next to them."""
    first, number = np.zeros(len(counts), int), np.ones(len(counts), int)
    left, at, used, full = set(range(len(counts))), 0, 0, 0
    while left:
        left.remove(at)
        number[at] = max(1, -(-counts[at] // block_rows))
        if full and full + counts[at] > block_rows:
            used, full = used + 1, 0
        first[at], full = used, full + counts[at]
        if number[at] > 1:
            used, full = used + number[at], 0
        at = min(left, key=lambda c: between[at, c], default=0)
    return first, number, used + bool(full)


def _groups(asked: np.ndarray, between: np.ndarray, lower: np.ndarray, histogram: np.ndarray, edges: np.ndarray, group_rows: int):
    """The group of each query cell, the parts and the needed distances of each group, at the least work.

    A row that moves is taken to cost as much as 2000 inner products; the choice changes no result.
    """
    best = None
    groups = 1
    while groups <= len(between):
        group_of = between[:, :groups].argmin(1)
        size = np.bincount(group_of, weights=asked, minlength=groups).astype(int)
        parts = np.maximum(1, -(-size // group_rows))
        needed = np.array([lower[(group_of == g) & (asked > 0)].min(0, initial=np.inf) for g in range(groups)])
        moved = np.array([histogram[edges[None, :] >= need[:, None]].sum() for need in needed])
        cost = (moved * parts).sum() + (moved * size).sum() / 2000
        if best is None or cost < best[0]:
            best = cost, group_of, parts, needed
        groups *= 2
    return best[1:]


def meetings(
    vectors: DataFrame, k: int, work: Workspace, *, pivots: int = 64, group_rows: int = 4096, block_rows: int = 32768
) -> Meetings | None:
    """Where the queries among ``vectors`` (``vec_id, v array<long>, is_query``) meet vectors; None without queries.

    ``pivots`` bounds the summaries on the driver, ``group_rows`` the queries and ``block_rows`` the vectors
    that meet in one task; neither drops anything.
    """
    base = work.table(
        vectors.where("v IS NOT NULL").select(
            F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long"), "v",
            (F.coalesce("is_query", F.lit(False)) & F.col("vec_id").isNotNull()).alias("is_query"),
        ),
        "vectors",
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total = base.agg(
        F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("most"), F.count_if("is_query").alias("asked")
    ).first()
    if not total["n"] or not total["asked"]:
        return None
    dim, most = int(total["dim"]), float(total["most"])
    chosen = base.orderBy(F.xxhash64("uid"), "uid").limit(pivots).collect()
    centres = _matrix([r["v"] for r in chosen], dim)

    def fill(points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(most - (points.astype(float) ** 2).sum(1), 0))

    def assign(batches):
        corner = fill(centres)
        for batch in batches:
            points = _matrix(batch.column("v").to_pylist(), dim)
            data = _distances(points, fill(points), centres, corner)
            asked = _distances(points, np.zeros(len(points)), centres, corner)
            rows = np.arange(len(points))
            new = [data.argmin(1).astype(np.int32), asked.argmin(1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("uid", "vec_id", "v", "is_query")]
                + [pa.array(new[0]), pa.array(data[rows, new[0]]), pa.array(new[1]), pa.array(asked[rows, new[1]])],
                names=["uid", "vec_id", "v", "is_query", "cell", "dist", "q_cell", "q_dist"],
            )

    schema = "uid long, vec_id long, v array<long>, is_query boolean, cell int, dist double, q_cell int, q_dist double"
    cells = work.table(base.mapInArrow(assign, schema), "cells")

    nearest = Window.partitionBy("cell").orderBy("dist")
    summary = (
        cells.select("cell", "dist", F.row_number().over(nearest).alias("place")).where(F.col("place") <= k + 1)
        .groupBy("cell").agg(F.array_agg("dist").alias("near")).collect()
    )
    corner = fill(centres)
    between = _distances(centres, corner, centres, corner)
    slack = 1e-6 * (1 + np.sqrt(most))
    step = (2 * np.sqrt(most) + slack) / BINS  # no distance is longer: all lie on a half sphere
    histogram, counts = np.zeros((len(centres), BINS), np.int64), np.zeros(len(centres), np.int64)
    place = F.least(F.floor(F.col("dist") / step), F.lit(BINS - 1)).cast("int")
    for row in cells.groupBy("cell", place.alias("bin")).count().collect():
        histogram[row["cell"], row["bin"]] = row["count"]
    counts = histogram.sum(1)

    asked, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for row in cells.where("is_query").groupBy("q_cell").agg(F.max("q_dist").alias("radius"), F.count("*").alias("n")).collect():
        asked[row["q_cell"]], radius[row["q_cell"]] = row["n"], row["radius"]
    reach = np.full(len(centres), np.inf)
    for i in np.flatnonzero(asked):
        found = sorted(radius[i] + between[i, s["cell"]] + d for s in summary for d in s["near"])
        if len(found) > k:
            reach[i] = radius[i] + found[k]
    first_search = _first_search(cells, counts, asked, k, dim, group_rows, block_rows)
    for row in _reaches(first_search, cells, square, most, k).collect():
        if row["queries"] == asked[row["q_cell"]]:  # each query of the cell found k
            reach[row["q_cell"]] = min(reach[row["q_cell"]], row["reach"])
    lower = between - reach[:, None] - slack
    edges = (np.arange(BINS) + 1) * step
    group_of, parts, needed = _groups(asked, between, lower, histogram, edges, group_rows)
    groups = len(parts)
    first, number, blocks = _blocks(counts, between, block_rows)

    def route(batches):
        for batch in batches:
            cell, dist, uid = (batch.column(c).to_numpy() for c in ("cell", "dist", "uid"))
            for g in range(groups):
                rows = np.flatnonzero(dist >= needed[g][cell])
                if not len(rows):
                    continue
                picked = batch.take(pa.array(rows))
                spread = uid[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                block = first[cell[rows]] + (spread % number[cell[rows]].astype(np.uint64)).astype(np.int64)
                for part in range(parts[g]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), g, np.int32)), pa.array(np.full(len(rows), part, np.int32)),
                         pa.array(block.astype(np.int32)), *(picked.column(c) for c in ("uid", "vec_id", "v"))],
                        names=["grp", "part", "block", "uid", "vec_id", "v"],
                    )

    keys = ["grp", "part", "block"]
    routed = cells.mapInArrow(route, "grp int, part int, block int, uid long, vec_id long, v array<long>")
    # the cells of a group that hold a vector far enough, as ranges of blocks
    farthest = np.array([edges[np.flatnonzero(h)[-1]] if h.any() else -np.inf for h in histogram])
    ranges = [{int(first[c]): int(number[c]) for c in np.argsort(number) if farthest[c] >= needed[g][c]} for g in range(groups)]
    nothing = F.expr("cast(array() AS array<struct<s: int, n: int>>)")
    named = F.array(*(
        F.array(*(F.struct(F.lit(a).alias("s"), F.lit(n).alias("n")) for a, n in sorted(r.items()))) if r else nothing for r in ranges
    ))
    group_map, part_map = F.array(*map(F.lit, group_of.tolist())), F.array(*map(F.lit, parts.tolist()))
    questions = (
        cells.where("is_query").withColumn("grp", group_map[F.col("q_cell")].cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("uid"), part_map[F.col("grp")]).cast("int"))
        .withColumn("range", F.explode(named[F.col("grp")]))
        .withColumn("block", F.explode(F.expr("sequence(range.s, range.s + range.n - 1)")))
        .select(*keys, "uid", "vec_id", "v")
    )
    return Meetings(questions, routed, int(total["n"]), int(total["asked"]), int(blocks), dim)


def _first_search(cells: DataFrame, counts: np.ndarray, asked: np.ndarray, k: int, dim: int, group_rows: int, block_rows: int) -> DataFrame:
    """The best k of each query among at most about ``block_rows`` vectors of its own cell."""
    of = F.array(*(F.lit(int(x)) for x in np.maximum(1, -(-counts // block_rows))))
    parts = F.array(*(F.lit(int(x)) for x in -(-asked // group_rows)))
    data = cells.where((F.pmod(F.xxhash64("uid"), of[F.col("cell")]) == 0) & (parts[F.col("cell")] > 0))
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), parts[F.col("cell")] - 1)))
    data = data.select(*(F.col(c).alias(f"d_{c}") for c in ("cell", "part", "uid", "vec_id", "v")))  # the two sides come from one table
    queries = cells.where("is_query").withColumn("part", F.pmod(F.xxhash64("uid"), parts[F.col("q_cell")]).cast("int"))
    queries = queries.select(F.col("q_cell").alias("cell"), "part", "uid", "vec_id", "v")
    return queries.groupBy("cell", "part").cogroup(data.groupBy("d_cell", "d_part")).applyInPandas(
        lambda q, d: _best(q, d.rename(columns=lambda c: c.removeprefix("d_")), k, dim), RESULT
    )


def _reaches(found: DataFrame, cells: DataFrame, square: Column, most: float, k: int) -> DataFrame:
    """``q_cell, reach, queries``: how far from the pivot a neighbour of one of the cell's queries may be."""
    last = found.groupBy("query_uid").agg(F.count("*").alias("c"), F.min("score").alias("score")).where(F.col("c") >= k)
    joined = cells.where("is_query").select(F.col("uid").alias("query_uid"), "q_cell", "q_dist", square.alias("square")).join(last, "query_uid")
    radius = F.sqrt(F.greatest(F.lit(0.0), F.col("square") + F.lit(most) - 2 * F.col("score").cast("double")))
    return joined.groupBy("q_cell").agg(F.max(F.col("q_dist") + radius).alias("reach"), F.count("*").alias("queries"))


def top_k(vectors: DataFrame, k: int, work: Workspace, **sizes: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``vectors`` (``vec_id, v array<long>, is_query``); ``sizes`` as in ``meetings``."""
    met = meetings(vectors, k, work, **sizes)
    if met is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    keys, dim = ["grp", "part", "block"], met.dim
    local = met.questions.groupBy(*keys).cogroup(met.routed.groupBy(*keys)).applyInPandas(lambda q, d: _best(q, d, k, dim), RESULT)
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return (
        local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
