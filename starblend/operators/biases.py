"""Regularised user and item biases, and the prediction made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starblend.functions import clamp
from starblend.operators.skew import KeyedRows, attach, too_large_to_broadcast
from starblend.workspace import Workspace


def _shrunk_mean(rows: DataFrame, key: str, name: str, residual: Column, lam: float) -> DataFrame:
    """Per ``key``: sum of residuals over (lam + number of rows)."""
    return rows.groupBy(key).agg(
        (F.sum(residual) / (F.lit(float(lam)) + F.count(F.lit(1)))).alias(name)
    )


def fit_biases(
    history: DataFrame,
    mean: float,
    lam: float = 9.0,
    rounds: int = 4,
    work: Workspace | None = None,
    hot_users: DataFrame | None = None,
    hot_items: DataFrame | None = None,
    rows: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """``(user_id, bu)`` and ``(business_id, bi)`` after ``rounds`` alternating updates from zero.

    Each half-round is a join of the ratings with one bias per key and a sum with partial
    aggregation; what it yields is written out, so the next half-round starts from a short plan.
    Where the biases are too large to broadcast, the ratings, ``rows`` of them, are stored in buckets by user
    and by item once instead of being shuffled in every round.
    """
    if rounds < 1:
        raise ValueError("at least one round is needed")
    work = work or Workspace(history.sparkSession).close_at_exit()
    by_user = KeyedRows(history, "user_id", hot_users, work, rows)
    by_item = KeyedRows(history, "business_id", hot_items, work, rows)
    off_mean = F.col("stars") - F.lit(float(mean))

    def with_item_bias(item_bias: DataFrame) -> DataFrame:
        stored = by_user.stored
        if stored is None or too_large_to_broadcast(item_bias):
            return by_item.attach(item_bias)
        return stored.join(item_bias, "business_id", "left")  # rows in buckets by user are summed where they lie

    try:
        user_bias = work.table(_shrunk_mean(history, "user_id", "bu", off_mean, lam), "user-bias")
        for last in range(1, rounds + 1):
            item_bias = work.table(
                _shrunk_mean(by_user.attach(user_bias), "business_id", "bi", off_mean - F.col("bu"), lam),
                "item-bias",
            )
            if last < rounds:
                user_bias = work.table(
                    _shrunk_mean(with_item_bias(item_bias), "user_id", "bu", off_mean - F.col("bi"), lam),
                    "user-bias",
                )
    finally:
        by_user.release()
        by_item.release()
    return user_bias, item_bias


def bias_score(mean: float, bu: str | Column = "bu", bi: str | Column = "bi") -> Column:
    """Clamped mean + user bias + item bias; an unknown id counts 0."""
    bu = F.col(bu) if isinstance(bu, str) else bu
    bi = F.col(bi) if isinstance(bi, str) else bi
    zero = F.lit(0.0)
    return clamp(F.lit(float(mean)) + F.coalesce(bu, zero) + F.coalesce(bi, zero))


def bias_predict(
    pairs: DataFrame,
    user_bias: DataFrame,
    item_bias: DataFrame,
    mean: float,
    hot_users: DataFrame | None = None,
    hot_items: DataFrame | None = None,
) -> DataFrame:
    """``pairs`` with a column ``bias``."""
    joined = attach(pairs, user_bias, "user_id", hot_users)
    joined = attach(joined, item_bias, "business_id", hot_items)
    return joined.withColumn("bias", bias_score(mean)).drop("bu", "bi")
