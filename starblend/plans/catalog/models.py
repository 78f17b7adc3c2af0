"""The four predictors, the blend and the reports."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from starblend.operators import (
    biases,
    blend,
    boosted,
    evaluate,
    latent,
    neighbours,
    profile,
    skew,
)
from starblend.operators.blend import Weights
from starblend.operators.blocks import meet, of_blocks, packed, targeted
from starblend.plans import tables
from starblend.plans.catalog.profiles import profile_sql
from starblend.plans.catalog.registry import (
    biases_sql,
    query,
    r6,
    ratings_sql,
    rounded,
    space,
    sql_r6,
)
from starblend.plans.presets import AGGRESSIVE, STABLE
from starblend.plans.recommender import HybridRecommender, Sides

DENSE = f"WITH {ratings_sql()}"
SPARSE = f"WITH {ratings_sql('l_partkey')}"
BIASED = f"{DENSE}, {biases_sql()}"
SPARSE_BIASED = f"{SPARSE}, {biases_sql()}"
BASE = "least(5, greatest(1, m + coalesce(bu, 0) + coalesce(bi, 0)))"
SCORED_SQL = f"""scored AS (
  SELECT user_id, business_id, stars AS truth, l_shipdate, l_orderkey, l_linenumber,
    {BASE} AS bias
  FROM test LEFT JOIN u4 USING (user_id) LEFT JOIN b4 USING (business_id), g)"""


class _Fitted:
    """Train rows, history, mean and biases of one rating view."""

    def __init__(self, spark, sf, item="l_suppkey"):
        self.work = space(spark)
        ratings = self.work.table(tables.rating_rows(spark, sf, item), "ratings")
        self.train = tables.train_rows(ratings)
        self.test = tables.test_rows(ratings)
        self.history = self.work.table(
            profile.dedupe_ratings(self.train, tables.line_order()), "history"
        )
        self.mean = profile.global_mean(self.train).first()["global_mean"]
        self.bu, self.bi = biases.fit_biases(self.history, self.mean, work=self.work)

    def biased(self):
        return biases.bias_predict(self.test, self.bu, self.bi, self.mean)


@query(f"{BIASED} SELECT user_id, {sql_r6('bu')} AS bu FROM u4")
def fit_biases_user(spark, sf):
    return rounded(_Fitted(spark, sf).bu, "bu")


@query(f"{BIASED} SELECT business_id, {sql_r6('bi')} AS bi FROM b4")
def fit_biases_item(spark, sf):
    return rounded(_Fitted(spark, sf).bi, "bi")


_BIAS_ROWS = f"""{BIASED}, {SCORED_SQL}
SELECT user_id, business_id, l_orderkey, l_linenumber, truth, {sql_r6("bias")} AS bias FROM scored"""


@query(_BIAS_ROWS)
def bias_predict(spark, sf):
    scored = _Fitted(spark, sf).biased()
    return rounded(
        scored.select("user_id", "business_id", "row_id.l_orderkey", "row_id.l_linenumber",
                      "truth", "bias"),
        "bias",
    )


@query(_BIAS_ROWS)
def bias_predict_hot_keys(spark, sf):
    """The same rows with the busiest users and items taken through the hot-key path."""
    fit = _Fitted(spark, sf)
    total = fit.test.count()
    by_user, by_item = profile.user_counts(fit.test), profile.item_counts(fit.test)
    hot_users = skew.hot_keys(by_user, "user_id", total, hot_rows=6)
    hot_items = skew.hot_keys(by_item, "business_id", total, hot_rows=60)
    scored = biases.bias_predict(fit.test, fit.bu, fit.bi, fit.mean, hot_users, hot_items)
    return rounded(
        scored.select("user_id", "business_id", "row_id.l_orderkey", "row_id.l_linenumber",
                      "truth", "bias"),
        "bias",
    )


@query(f"""{BIASED}, {SCORED_SQL}
SELECT {sql_r6("sqrt(avg(pow(bias - truth, 2)))")} AS rmse FROM scored""")
def rmse(spark, sf):
    return rounded(evaluate.rmse(_Fitted(spark, sf).biased(), "bias"), "rmse")


@query(f"""{BIASED}, {SCORED_SQL},
buckets AS (SELECT least(4, CAST(floor(abs(CAST(bias AS FLOAT) - CAST(truth AS FLOAT))) AS INTEGER)) AS bucket
            FROM scored)
SELECT CAST(s AS INTEGER) AS bucket, count(bucket) AS n
FROM generate_series(0, 4) t(s) LEFT JOIN buckets ON bucket = s GROUP BY s""")
def error_histogram(spark, sf):
    return evaluate.error_histogram(_Fitted(spark, sf).biased(), "bias")


@query(f"""{DENSE}
SELECT user_id, business_id, stars FROM train
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY business_id, stars) <= 20""")
def cap_user_items(spark, sf):
    train = tables.train_rows(tables.rating_rows(spark, sf))
    return neighbours.cap_user_items(train.drop("row_id"), 20, "stars")


@query(f"""{DENSE}
SELECT x.business_id AS item_a, y.business_id AS item_b, count(*) AS n,
  sum(x.stars * y.stars) AS products
FROM train x JOIN train y USING (user_id) WHERE x.business_id < y.business_id GROUP BY 1, 2""")
def item_pairs(spark, sf):
    train = tables.train_rows(tables.rating_rows(spark, sf)).select("user_id", "business_id", "stars")
    train = space(spark).table(train, "paired")
    pairs = neighbours.item_pairs(train, neighbours.heavy_users(train), neighbours.busy_items(train))
    return pairs.groupBy("item_a", "item_b").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("a") * F.col("b")).alias("products")
    )


def _sims_sql(shrink: float) -> str:
    n = "CAST(count(*) AS DOUBLE)"
    return f"""sims AS MATERIALIZED (
  SELECT x.business_id AS item_a, y.business_id AS item_b, count(*) AS n,
    ({n} * sum(x.stars * y.stars) - sum(x.stars) * sum(y.stars))
    / (sqrt({n} * sum(x.stars * x.stars) - pow(sum(x.stars), 2))
       * sqrt({n} * sum(y.stars * y.stars) - pow(sum(y.stars), 2)))
    * ({n} / ({n} + CAST({shrink} AS DOUBLE))) AS sim
  FROM train x JOIN train y USING (user_id) WHERE x.business_id < y.business_id
  GROUP BY 1, 2
  HAVING count(*) >= 3 AND {n} * sum(x.stars * x.stars) > pow(sum(x.stars), 2)
     AND {n} * sum(y.stars * y.stars) > pow(sum(y.stars), 2))"""


_SIM_ROWS = f"SELECT item_a, item_b, n, {sql_r6('sim')} AS sim FROM sims"


def _similar(train, shrink, at_least=0.0, block=None):
    rows = space(train.sparkSession).table(train.select("user_id", "business_id", "stars"), "paired")
    heavy, busy = neighbours.heavy_users(rows, block), neighbours.busy_items(rows)
    return neighbours.item_similarities(rows, shrink, at_least, heavy, busy=busy)


@query(f"{DENSE}, {_sims_sql(5)} {_SIM_ROWS}")
def item_similarities(spark, sf):
    return rounded(_similar(tables.train_rows(tables.rating_rows(spark, sf)), STABLE.shrink), "sim")


@query(f"{DENSE}, {_sims_sql(5)} {_SIM_ROWS}")
def item_similarities_split_users(spark, sf):
    """The same rows with nearly every user's ratings paired block by block."""
    train = tables.train_rows(tables.rating_rows(spark, sf))
    return rounded(_similar(train, STABLE.shrink, block=8), "sim")


@query(f"{SPARSE}, {_sims_sql(20)} {_SIM_ROWS}")
def item_similarities_sparse(spark, sf):
    train = tables.train_rows(tables.rating_rows(spark, sf, "l_partkey"))
    return rounded(_similar(train, AGGRESSIVE.shrink), "sim")


@query(f"""{SPARSE}, hot AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN user_id % 2 - 2 ELSE user_id END AS user_id, business_id, max(stars) AS stars
  FROM train GROUP BY 1, 2), {_sims_sql(5).replace("FROM train x JOIN train y", "FROM hot x JOIN hot y")} {_SIM_ROWS}""")
def item_similarities_hot_users(spark, sf):
    """Two users hold a third of all ratings, one of each item: they propose no pairs."""
    user = F.when(F.col("user_id") % 3 == 0, F.col("user_id") % 2 - 2).otherwise(F.col("user_id"))
    train = tables.train_rows(tables.rating_rows(spark, sf, "l_partkey"))
    work = space(spark)
    rows = work.table(train.groupBy(user.alias("user_id"), "business_id").agg(F.max("stars").alias("stars")), "hot-users")
    return rounded(neighbours.similarities_of(rows, work, STABLE.shrink, block=200), "sim")


@query(f"""{DENSE.replace("train AS (SELECT * FROM ratings", "train AS (SELECT * REPLACE "
  "(CASE WHEN business_id % 7 = 0 THEN 3.1 ELSE round(1 + l_discount * 40, 1) END AS stars) FROM ratings")
  .replace("l_linenumber\n", "l_linenumber, l_discount\n", 1)},
sims AS (
  SELECT x.business_id AS item_a, y.business_id AS item_b, count(*) AS n,
    corr(x.stars, y.stars) * (count(*) / (count(*) + CAST(5 AS DOUBLE))) AS sim
  FROM train x JOIN train y USING (user_id) WHERE x.business_id < y.business_id
  GROUP BY 1, 2
  HAVING count(*) >= 3 AND min(x.stars) < max(x.stars) AND min(y.stars) < max(y.stars))
{_SIM_ROWS}""")
def item_similarities_decimal_stars(spark, sf):
    """Stars in steps of 0.4, and every seventh item rated 3.1 by everybody: it is similar to none."""
    stars = F.when(F.col("l_suppkey") % 7 == 0, F.lit(3.1)).otherwise(F.round(1 + F.col("l_discount") * 40, 1))
    train = tables.train_rows(tables.rating_rows(spark, sf, stars=stars))
    return rounded(_similar(train, STABLE.shrink), "sim")


@query(f"""{BIASED}
SELECT user_id, business_id, {sql_r6("stars - (m + bu + bi)")} AS resid
FROM history JOIN u4 USING (user_id) JOIN b4 USING (business_id), g""")
def history_residuals(spark, sf):
    fit = _Fitted(spark, sf)
    return rounded(
        neighbours.history_residuals(fit.history, fit.bu, fit.bi, fit.mean), "resid"
    )


def _cf_sql(preset) -> str:
    return f"""targets AS (SELECT DISTINCT user_id, business_id FROM test),
twoway AS (SELECT item_a AS business_id, item_b AS nb, sim FROM sims
         UNION ALL SELECT item_b, item_a, sim FROM sims),
found AS (
  SELECT t.user_id, t.business_id, nb,
    sign(sim) * pow(abs(sim), CAST({preset.alpha} AS DOUBLE)) AS w,
    least({preset.resid_cap}, greatest(-{preset.resid_cap}, h.stars - (m + bu + b4.bi))) AS resid
  FROM targets t JOIN history h ON h.user_id = t.user_id AND h.business_id <> t.business_id
  JOIN twoway ON twoway.business_id = t.business_id AND nb = h.business_id
  JOIN u4 ON u4.user_id = t.user_id JOIN b4 ON b4.business_id = h.business_id, g
  WHERE abs(sim) >= {preset.threshold}),
moves AS (
  SELECT user_id, business_id, sum(w * resid) AS num, sum(abs(w)) AS den, count(*) AS support
  FROM (SELECT * FROM found QUALIFY row_number() OVER (
    PARTITION BY user_id, business_id ORDER BY abs(w) DESC, nb) <= {preset.neighbours})
  GROUP BY 1, 2),
scored AS (
  SELECT user_id, business_id, stars AS truth, l_orderkey, l_linenumber, {BASE} AS bias,
    CASE WHEN den > {preset.gate} THEN least(5, greatest(1, {BASE} + num / den)) ELSE {BASE} END AS cf,
    coalesce(support, 0) AS support
  FROM test LEFT JOIN u4 USING (user_id) LEFT JOIN b4 USING (business_id)
  LEFT JOIN moves USING (user_id, business_id), g)
"""


_CF_ROWS = f"""SELECT user_id, business_id, l_orderkey, l_linenumber, truth,
  {sql_r6("bias")} AS bias, {sql_r6("cf")} AS cf, support FROM scored"""


def _cf_rows(fit, preset):
    sims = fit.work.table(_similar(fit.train, preset.shrink, preset.threshold), "sims")
    return neighbours.cf_predict(
        fit.biased(), fit.history, sims, fit.bu, fit.bi, fit.mean, preset.threshold,
        preset.neighbours, preset.alpha, preset.resid_cap, preset.gate, fit.work,
    )


@contextmanager
def _lowered(**limits):
    """Operator limits lowered for one plan, so that small tables take the paths of large ones."""
    before = {(m, n): getattr(m, n) for n, (m, _) in limits.items()}
    for name, (module, value) in limits.items():
        setattr(module, name, value)
    try:
        yield
    finally:
        for (module, name), value in before.items():
            setattr(module, name, value)


def _cf_columns(scored):
    return rounded(
        scored.select("user_id", "business_id", "row_id.l_orderkey", "row_id.l_linenumber",
                      "truth", "bias", "cf", "support"),
        "bias", "cf",
    )


@query(f"{BIASED}, {_sims_sql(5)}, {_cf_sql(STABLE)} {_CF_ROWS}")
def cf_predict(spark, sf):
    return _cf_columns(_cf_rows(_Fitted(spark, sf), STABLE))


@query(f"{BIASED}, {_sims_sql(5)}, {_cf_sql(STABLE)} {_CF_ROWS}")
def cf_predict_hot_keys(spark, sf):
    """The same rows with busy users, items and pairs taken apart and candidates split."""
    with _lowered(HOT_ROWS=(skew, 200), ROWS_PER_SPLIT=(neighbours, 5_000)):
        return _cf_columns(_cf_rows(_Fitted(spark, sf), STABLE))


@query(f"{SPARSE_BIASED}, {_sims_sql(20)}, {_cf_sql(AGGRESSIVE)} {_CF_ROWS}")
def cf_predict_sparse(spark, sf):
    return _cf_columns(_cf_rows(_Fitted(spark, sf, "l_partkey"), AGGRESSIVE))


@query(f"""{BIASED}, {_sims_sql(5)}, {_cf_sql(STABLE)}
SELECT 'bias' AS model, {sql_r6("sqrt(avg(pow(bias - truth, 2)))")} AS rmse FROM scored
UNION ALL SELECT 'cf', {sql_r6("sqrt(avg(pow(cf - truth, 2)))")} FROM scored""")
def ablation(spark, sf):
    scored = _cf_rows(_Fitted(spark, sf), STABLE)
    return rounded(evaluate.ablation(scored, ["bias", "cf"]), "rmse")


# Factor vectors made from table columns, to check the scoring by SQL.
_USER_VECTOR = ["c_acctbal / 10007", "c_nationkey / 25.0D", "(c_custkey % 7) / 7.0D", "1.0D"]
_ITEM_VECTOR = ["s_acctbal / 10007", "s_nationkey / 25.0D", "(s_suppkey % 5) / 5.0D", "-0.5D"]
_VECTORS_SQL = f"""p AS (SELECT c_custkey AS user_id,
  {", ".join(f"CAST({e.replace('D', '')} AS DOUBLE) AS p{i}" for i, e in enumerate(_USER_VECTOR))} FROM customer),
q AS (SELECT s_suppkey AS business_id,
  {", ".join(f"CAST({e.replace('D', '')} AS DOUBLE) AS q{i}" for i, e in enumerate(_ITEM_VECTOR))} FROM supplier
  WHERE s_suppkey % 10 > 0),
y AS (SELECT user_id, {", ".join(f"0.6 * avg(q{i}) AS y{i}" for i in range(4))}
  FROM history JOIN q USING (business_id) GROUP BY user_id)"""


def _user_factors(spark, sf):
    return tables.load(spark, sf, "customer").selectExpr(
        "c_custkey AS user_id", f"array({', '.join(_USER_VECTOR)}) AS p"
    )


def _item_factors(spark, sf):
    return tables.load(spark, sf, "supplier").where("s_suppkey % 10 > 0").selectExpr(
        "s_suppkey AS business_id", f"array({', '.join(_ITEM_VECTOR)}) AS q"
    )


@query(f"""{DENSE}, {_VECTORS_SQL}
SELECT user_id, {", ".join(f"{sql_r6(f'y{i}')} AS y{i}" for i in range(4))} FROM y""")
def implicit_user_vectors(spark, sf):
    train = tables.train_rows(tables.rating_rows(spark, sf))
    found = latent.implicit_user_vectors(
        profile.dedupe_ratings(train, tables.line_order()), _item_factors(spark, sf), 4
    )
    return found.select("user_id", *[r6(F.col("y")[i]).alias(f"y{i}") for i in range(4)])


@query(f"""{BIASED}, {_VECTORS_SQL}
SELECT user_id, business_id, l_orderkey, l_linenumber,
  {sql_r6('''CASE WHEN q0 IS NULL OR p0 IS NULL THEN ''' + BASE + ''' ELSE
    least(5, greatest(1, m + coalesce(bu, 0) + coalesce(bi, 0) + '''
    + " + ".join(f"(p{i} + coalesce(y{i}, 0)) * q{i}" for i in range(4)) + ")) END")} AS latent
FROM test LEFT JOIN u4 USING (user_id) LEFT JOIN b4 USING (business_id)
LEFT JOIN p USING (user_id) LEFT JOIN y USING (user_id) LEFT JOIN q USING (business_id), g""")
def latent_score(spark, sf):
    fit = _Fitted(spark, sf)
    items = _item_factors(spark, sf)
    implicit = latent.implicit_user_vectors(fit.history, items, 4)
    users = latent.user_vectors(_user_factors(spark, sf), implicit, "user_id")
    scored = latent.latent_predict(fit.test, users, items, fit.bu, fit.bi, fit.mean)
    return rounded(
        scored.select("user_id", "business_id", "row_id.l_orderkey", "row_id.l_linenumber", "latent"),
        "latent",
    )


@query(f"{DENSE} SELECT user_id, business_id, stars AS truth, CAST(0 AS DOUBLE) AS gap, TRUE AS on_scale FROM test")
def latent_predict(spark, sf):
    """Factors of the preset, fitted on the residuals; ids of the tables are ints already.

    The solver ends with the users: with the item factors held, each user's factors solve the normal equations
    ``(sum q q' + reg n I) p = sum q r``.  ``gap`` is what is left of them, relative to the right-hand side.
    """
    fit = _Fitted(spark, sf)
    residuals = fit.work.table(
        neighbours.history_residuals(fit.history, fit.bu, fit.bi, fit.mean).select(
            F.col("user_id").cast("int").alias("u"), F.col("business_id").cast("int").alias("i"),
            "resid",
        ),
        "residuals",
    )
    rank = STABLE.rank
    rows = residuals.count()
    users, items = latent.fit_latent(residuals, rank, STABLE.latent_rounds, STABLE.latent_reg, rows, work=fit.work)
    users, items = fit.work.table(users, "user-factors"), fit.work.table(items, "item-factors")
    gaps = fit.work.table(_normal_gaps(residuals, users, items, STABLE.latent_reg), "gaps")
    users = users.select(F.col("u").cast("bigint").alias("user_id"), "p")
    items = items.select(F.col("i").cast("bigint").alias("business_id"), "q")
    implicit = latent.implicit_user_vectors(fit.history, items, rank, STABLE.implicit_alpha, rows=rows)
    users = fit.work.table(latent.user_vectors(users, implicit, "user_id"), "user-vectors")
    scored = latent.latent_predict(fit.test, users, items, fit.bu, fit.bi, fit.mean)
    scored = scored.join(gaps, "user_id", "left")
    return scored.select(
        "user_id", "business_id", "truth", F.coalesce("gap", F.lit(0.0)).alias("gap"),
        F.col("latent").between(1, 5).alias("on_scale"),
    )


def _normal_gaps(residuals, users, items, reg):
    """``user_id, gap``: length of ``sum q (p.q - r) + reg n p`` over the length of ``sum q r``, to 2 places."""
    rank, blocks = len(items.first()["q"]), latent.solver_blocks(residuals.count())

    def gaps(block):
        def weights(q, r, keys):
            return np.hstack([q * (np.einsum("nk,nk->n", block.own[keys].astype(np.float64), q) - r)[:, None], q * r[:, None]])

        for first, last, start, end in block.pieces():
            sums, n = block.sums(start, end, first, last, weights), block.counts[first:last]
            left = sums[:, :rank] + reg * n[:, None] * block.own[first:last]
            lengths = [np.sqrt((v * v).sum(axis=1)) for v in (left, sums[:, rank:])]
            met = (n > 0) & block.own_known[first:last]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids[first:last][met]), pa.array((lengths[0] / np.maximum(1e-3, lengths[1]))[met])], names=["user_id", "gap"]
            )

    by_id = {"u": users.select(F.col("u").cast("bigint").alias("id"), F.col("p").alias("vector")),
             "i": items.select(F.col("i").cast("bigint").alias("id"), F.col("q").alias("vector"))}
    rows = residuals.dropna(subset=["u", "i"])
    held = packed(rows, "u", "i", F.col("resid"), blocks)
    met = meet(held, targeted(by_id["i"], rows, "u", "i", blocks), blocks, own=by_id["u"])
    found = met.mapInArrow(of_blocks(rank, gaps), "user_id bigint, gap double")
    return found.select("user_id", (F.round("gap", 2) + 0.0).alias("gap"))


_STUMP_INPUTS = ["floor(l_quantity / 5)", "l_discount", "l_tax"]
_STUMP_RATE = 0.1


def _stump_sql(number: int, rows: str, target: str) -> str:
    """The best one-split tree for ``target``: least squares over every cut of every input."""
    cuts = " UNION ALL ".join(
        f"""SELECT {i} AS f, v, sum(n) OVER w AS n, sum(s) OVER w AS s FROM (
          SELECT x{i} AS v, count(*) AS n, sum({target}) AS s FROM {rows} GROUP BY x{i})
          WINDOW w AS (ORDER BY v)""" for i in range(len(_STUMP_INPUTS)))
    total = f"(SELECT count(*) AS tn, sum({target}) AS ts FROM {rows})"
    return f"""cut{number} AS MATERIALIZED (
  SELECT f, v, s / n AS low, (ts - s) / (tn - n) AS high
  FROM ({cuts}), {total} WHERE n < tn
  ORDER BY s * s / n + (ts - s) * (ts - s) / (tn - n) DESC LIMIT 1)"""


def _side(number: int) -> str:
    value = " ".join(f"WHEN {i} THEN x{i}" for i in range(len(_STUMP_INPUTS)))
    return f"CASE WHEN CASE cut{number}.f {value} END <= cut{number}.v THEN cut{number}.low ELSE cut{number}.high END"


@query(f"""
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, 1 + l_extendedprice / 30000 AS y,
  {", ".join(f"{e} AS x{i}" for i, e in enumerate(_STUMP_INPUTS))} FROM lineitem),
{_stump_sql(1, "d", "y")},
d1 AS (SELECT d.*, {_side(1)} AS first, y - {_side(1)} AS rest FROM d, cut1),
{_stump_sql(2, "d1", "rest")}
SELECT l_orderkey, l_linenumber, l_partkey,
  {sql_r6(f"least(5, greatest(1, first + {_STUMP_RATE} * {_side(2)}))")} AS boosted
FROM d1, cut2""")
def boosted_stumps(spark, sf):
    """Two boosting rounds of one-split trees, small enough to state in SQL."""
    rows = tables.load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "1 + l_extendedprice / 30000 AS stars",
        *[f"CAST({e} AS DOUBLE) AS x{i}" for i, e in enumerate(_STUMP_INPUTS)],
    )
    rows = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(rows)
    model = boosted.fit_boosted(
        rows, trees=2, depth=1, rate=_STUMP_RATE, row_share=1.0, column_share=1.0
    )
    scored = boosted.boosted_predict(rows, model)
    return rounded(scored.select("l_orderkey", "l_linenumber", "l_partkey", "boosted"), "boosted")


_BLEND = ["cf", "latent", "boosted"]
_BLEND_SQL = """inputs AS (SELECT l_orderkey, l_linenumber, l_partkey,
  1 + l_discount * 40 AS cf, 1 + l_tax * 50 AS latent, CAST(1 + l_quantity / 12.5 AS DOUBLE) AS boosted,
  CASE WHEN l_orderkey % 5 > 0 THEN 1 + l_extendedprice / 30000 END AS truth FROM lineitem)"""


def _blend_inputs(spark, sf):
    return tables.load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        "1 + l_discount * 40 AS cf", "1 + l_tax * 50 AS latent", "1 + l_quantity / 12.5D AS boosted",
        "CASE WHEN l_orderkey % 5 > 0 THEN 1 + l_extendedprice / 30000 END AS truth",
    )


def _moments_sql() -> str:
    names = [*_BLEND, "one"]
    sums = ["count(*) AS n"]
    for i, a in enumerate(names):
        sums += [f"sum({a} * {b}) AS {a}_{b}" for b in names[i:]] + [f"sum({a} * truth) AS {a}_y"]
    return (f"moments AS (SELECT {', '.join(sums)} FROM "
            "(SELECT *, CAST(1 AS DOUBLE) AS one FROM inputs WHERE truth IS NOT NULL))")


def _solve_sql() -> str:
    """Gauss elimination of the ridge equations, one CTE per step."""
    names = [*_BLEND, "one"]
    size = len(names)

    def cell(i, j):
        a, b = sorted((i, j))
        ridge = f" + {STABLE.blend_lam}" if i == j and i < size - 1 else ""
        return f"{names[a]}_{names[b]}{ridge} AS a{i}{j}"

    first = [cell(i, j) for i in range(size) for j in range(size)]
    first += [f"{names[i]}_y AS a{i}{size}" for i in range(size)]
    steps = [f"e0 AS (SELECT {', '.join(first)} FROM moments)"]
    for k in range(size):
        cells = []
        for i in range(size):
            for j in range(size + 1):
                value = (f"a{k}{j} / a{k}{k}" if i == k
                         else f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k}")
                cells.append(f"{value} AS a{i}{j}")
        steps.append(f"e{k + 1} AS (SELECT {', '.join(cells)} FROM e{k})")
    return ",\n".join(steps)


@query(f"""WITH {_BLEND_SQL}, {_moments_sql()}
SELECT n, {", ".join(f"round({c}, 2) AS {c}" for c in
  [f"{a}_{b}" for i, a in enumerate([*_BLEND, "one"]) for b in [*[*_BLEND, "one"][i:], "y"]])}
FROM moments""")
def blend_moments(spark, sf):
    found = blend.blend_moments(_blend_inputs(spark, sf), _BLEND)
    return found.select("n", *[F.round(c, 2).alias(c) for c in found.columns if c != "n"])


_SOLVED_SQL = f"""WITH {_BLEND_SQL}, {_moments_sql()}, {_solve_sql()},
weights AS (SELECT {", ".join(
    f"least({STABLE.bounds[m][1]}, greatest({STABLE.bounds[m][0]}, a{i}4)) AS w_{m}"
    for i, m in enumerate(_BLEND))}, a34 AS constant FROM e4)"""


@query(f"""{_SOLVED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, round(least(5, greatest(1,
  {" + ".join(f"w_{m} * {m}" for m in _BLEND)} + constant)), 5) AS prediction
FROM inputs, weights""")
def blend_fitted(spark, sf):
    inputs = _blend_inputs(spark, sf)
    moments = blend.blend_moments(inputs, _BLEND).first()
    weights = blend.fit_blend(moments, _BLEND, STABLE.blend_lam, STABLE.bounds)
    scored = blend.blend_predict(inputs, weights)
    return scored.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("prediction", 5).alias("prediction")
    )


def _default_sql(weights: Weights) -> str:
    total = " + ".join(f"CAST({w} AS DOUBLE) * {m}" for m, w in weights.of.items())
    return f"""WITH {_BLEND_SQL.replace("inputs AS (SELECT", "inputs AS (SELECT CAST(1 + l_linenumber / 2 AS DOUBLE) AS bias,")}
SELECT l_orderkey, l_linenumber, l_partkey,
  {sql_r6(f"least(5, greatest(1, {total} + CAST({weights.constant} AS DOUBLE)))")} AS prediction
FROM inputs"""


def _default_blend(spark, sf, weights):
    inputs = _blend_inputs(spark, sf).withColumn("bias", 1 + F.col("l_linenumber") / 2)
    scored = blend.blend_predict(inputs, weights)
    return rounded(
        scored.select("l_orderkey", "l_linenumber", "l_partkey", "prediction"), "prediction"
    )


@query(_default_sql(STABLE.default_weights))
def blend_default_stable(spark, sf):
    return _default_blend(spark, sf, STABLE.default_weights)


@query(_default_sql(AGGRESSIVE.default_weights))
def blend_default_aggressive(spark, sf):
    return _default_blend(spark, sf, AGGRESSIVE.default_weights)


@query(f"""{DENSE}
SELECT user_id, business_id, stars, l_orderkey, l_linenumber FROM ratings
ORDER BY l_shipdate, l_orderkey, l_linenumber, stars LIMIT 30000""")
def first_rows(spark, sf):
    """The rows that the optional bound ``blend_rows`` of a preset keeps: the first of the file."""
    found = blend.first_rows(tables.rating_rows(spark, sf), 30_000)
    return found.select("user_id", "business_id", "stars", "row_id.l_orderkey", "row_id.l_linenumber")


def _sides(spark, sf):
    return Sides(
        users=tables.side_users(spark, sf),
        businesses=tables.side_businesses(spark, sf),
        checkins=tables.side_checkins(spark, sf),
        tips=tables.side_tips(spark, sf),
        photos=tables.side_photos(spark, sf),
    )


#: Changes to the presets in the registered runs: none.  Tests set a few small trees here.
CHANGES: dict = {}
_RUNS: dict = {}


def hybrid_model(spark, sf, preset="stable", **changes):
    """The pipeline with every value of the preset, fitted on the training rows."""
    ratings = tables.train_rows(tables.rating_rows(spark, sf)).withColumn("row_id", tables.line_order())
    return HybridRecommender(preset, **CHANGES, **changes).fit(ratings, _sides(spark, sf))


def hybrid_run(spark, sf, preset="stable"):
    """The fitted pipeline and its stored predictions on the held-out rows; queries of one session share a run."""
    key = (spark.sparkContext.applicationId, sf, preset, repr(CHANGES))
    if key not in _RUNS:
        model = hybrid_model(spark, sf, preset)
        model.work.close_at_exit()
        predicted = model.transform(tables.test_rows(tables.rating_rows(spark, sf)))
        _RUNS[key] = model, model.work.table(predicted, "predicted")
    return _RUNS[key]


def hybrid_predictions(spark, sf, preset="stable"):
    """All four predictors and their blend on the held-out rows."""
    return hybrid_run(spark, sf, preset)[1].drop("row_id")


def _weights_gap(model, predicted) -> float:
    """How far the weights are from the cut solution of the ridge equations of ``predicted``; 0 if they are it."""
    preset = model.preset
    names = [*preset.inputs, "one"]
    moments = blend.blend_moments(predicted, preset.inputs).first()
    open_bounds = dict.fromkeys(preset.inputs, (-np.inf, np.inf))
    free = blend.fit_blend(moments, preset.inputs, preset.blend_lam, open_bounds)
    solved = np.array([*(free.of[m] for m in preset.inputs), free.constant])
    lhs = np.array([[moments[f"{a}_{b}"] if f"{a}_{b}" in moments else moments[f"{b}_{a}"] for b in names] for a in names])
    rhs = np.array([moments[f"{a}_y"] for a in names])
    ridge = np.array([preset.blend_lam] * len(preset.inputs) + [0.0])
    left = np.abs(lhs @ solved + ridge * solved - rhs).max() / np.abs(rhs).max()
    cut = [abs(model.weights.of[m] - np.clip(free.of[m], *preset.bounds[m])) for m in preset.inputs]
    return round(float(max(left, *cut, abs(model.weights.constant - free.constant))), 6) + 0.0


def _hybrid_sql(preset) -> str:
    return f"""{BIASED}, {_sims_sql(preset.shrink)}, {_cf_sql(preset)}
SELECT user_id, business_id, truth, {sql_r6("bias")} AS bias, {sql_r6("cf")} AS cf,
  CAST(0 AS DOUBLE) AS blend_gap, CAST(0 AS DOUBLE) AS weights_gap, TRUE AS on_scale FROM scored"""


def _checked(spark, sf, preset):
    """Biases and neighbour scores as they are; the blend by its equations and from the columns it blends."""
    model, predicted = hybrid_run(spark, sf, preset)
    again = blend.blend_score(model.weights)
    models = ["bias", "cf", "latent", "boosted", "prediction"]
    scale = reduce(lambda a, b: a & b, (F.col(m).between(1, 5) for m in models))
    return rounded(
        predicted.select(
            "user_id", "business_id", "truth", "bias", "cf", (F.col("prediction") - again).alias("blend_gap"),
            F.lit(_weights_gap(model, predicted)).alias("weights_gap"), scale.alias("on_scale"),
        ),
        "bias", "cf", "blend_gap",
    )


@query(_hybrid_sql(STABLE))
def hybrid(spark, sf):
    return _checked(spark, sf, "stable")


@query(f"""{BIASED}, {_sims_sql(STABLE.shrink)}, {_cf_sql(STABLE)}
SELECT user_id, business_id, truth, {sql_r6("bias")} AS bias, {sql_r6("cf")} AS cf FROM scored""")
def hybrid_bias_cf(spark, sf):
    """The two predictors of the whole run that SQL can state."""
    scored = hybrid_run(spark, sf)[1]
    return rounded(scored.select("user_id", "business_id", "truth", "bias", "cf"), "bias", "cf")


@query(_hybrid_sql(AGGRESSIVE))
def hybrid_aggressive(spark, sf):
    return _checked(spark, sf, "aggressive")


@query(f"""{profile_sql(BIASED)}, {_sims_sql(STABLE.shrink)}, {_cf_sql(STABLE)},
checked(report, name) AS (VALUES ('rmse', 'latent'), ('rmse', 'boosted'), ('rmse', 'prediction'), ('holdout', 'prediction'),
  {", ".join(f"('weights', '{m}')" for m in [*STABLE.inputs, "constant"])})
SELECT 'rmse' AS report, 'bias' AS name, {sql_r6("sqrt(avg(pow(bias - truth, 2)))")} AS value FROM scored
UNION ALL SELECT 'rmse', 'cf', {sql_r6("sqrt(avg(pow(cf - truth, 2)))")} FROM scored
UNION ALL SELECT 'errors', 'all', CAST(count(*) AS DOUBLE) FROM scored
UNION ALL SELECT 'profile', metric, value FROM figures
UNION ALL SELECT report, name, CAST(1 AS DOUBLE) FROM checked""")
def hybrid_report(spark, sf):
    """The reports of one run as rows ``report, name, value``.

    Errors of the models that SQL cannot state are 1 if they lie in (0, 4), weights 1 if they lie in the preset's
    bounds; ``errors`` is the sum of the buckets.
    """
    model, predicted = hybrid_run(spark, sf)
    reports = model.evaluate(predicted)
    plausible = ((F.col("value") > 0) & (F.col("value") < 4)).cast("double")
    found = reports["ablation"].select(F.lit("rmse").alias("report"), F.col("model").alias("name"), F.col("rmse").alias("value"))
    found = found.unionByName(
        reports["holdout"].select(F.lit("holdout").alias("report"), F.lit("prediction").alias("name"), F.col("rmse").alias("value"))
    ).withColumn("value", F.when(F.col("name").isin("bias", "cf"), r6("value")).otherwise(plausible))
    errors = reports["errors"].agg(F.sum("n").cast("double").alias("value"))
    bounds = {**model.preset.bounds, "constant": (-10.0, 10.0)}
    within = F.coalesce(*(
        F.when(F.col("name") == m, F.col("weight").between(low, high).cast("double")) for m, (low, high) in bounds.items()
    ))
    return (
        found.unionByName(errors.select(F.lit("errors").alias("report"), F.lit("all").alias("name"), "value"))
        .unionByName(reports["weights"].select(F.lit("weights").alias("report"), "name", within.alias("value")))
        .unionByName(reports["profile"].select(F.lit("profile").alias("report"), F.col("metric").alias("name"), r6("value").alias("value")))
    )
