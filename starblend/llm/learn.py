"""Bounded labelled samples and the calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starblend.llm.common import held_out

#: Bytes of text that a class is learned from at the most, and bytes of a text beyond which another one takes its place.
LEARN_BYTES = 64 << 20
LONGEST_LEARNED = 4 << 20


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: dict[int, int]
) -> tuple[dict[int, list[bytes]], dict[int, int]]:
    """At most ``rows[c]`` texts and ``LEARN_BYTES`` of each class in a fixed random order, and how many rows each class has in all.

    Rows of the held-out fold are never taken.  A document labelled twice counts with its lesser label, and of an id with
    several texts the one with the least hash is taken.  The sample is the only thing that reaches the driver; it is cut to its
    bounds before, so its size does not grow with the tables or the rows of an id.
    """
    named = labels.where(~held_out() & F.col(label).isin(*rows)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts: dict[int, list[bytes]] = {}
    for c, most in rows.items():
        chosen = named.where(F.col("label") == c).orderBy(*order).limit(2 * most)  # twice as many, for those that are passed over
        found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
        found = found.where(F.octet_length("text") <= LONGEST_LEARNED)
        found = found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        # a window without keys sees these few rows only
        size = F.sum(F.octet_length("text")).over(Window.orderBy(*order))
        taken = found.orderBy(*order).limit(most).withColumn("size", size).where(F.col("size") <= LEARN_BYTES)
        texts[c] = [bytes(r["text"]) for r in taken.orderBy(*order).select("text").collect()]
    return texts, {c: counts.get(c, 0) for c in rows}


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    penalty = ridge * np.r_[np.ones(x.shape[1] - 1), 0]
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give the classes of a sample the shares they have in the whole table."""
    total = sum(counts.values()) or 1
    share = {c: max(counts.get(c, 0) / total, 1e-6) for c in (0, 1)}
    drawn = {c: max(int((y == c).sum()), 1) for c in (0, 1)}
    return np.where(y == 1, share[1] / drawn[1], share[0] / drawn[0])
