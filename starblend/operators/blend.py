"""Ridge blend of the model scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starblend.functions import clamp


# Lines counted together when the first rows of an input are looked for.
BLOCK_LINES = 1_000_000


@dataclass(frozen=True)
class Weights:
    """One weight per model, and a constant."""

    of: Mapping[str, float]
    constant: float


def first_rows(rows: DataFrame, n: int, order: str = "row_id") -> DataFrame:
    """The first ``n`` rows by ``order``, without ranking all rows in one task.

    ``order`` is a line number or a struct.  Rows are counted per leading part of it (a block of
    lines, or the struct's first field), parts past the n-th row are dropped, and only what is left
    is sorted: ``n`` rows and the rest of one part.
    """
    kind = rows.schema[order].dataType
    if isinstance(kind, T.StructType):
        lead = F.col(order)[kind.fieldNames()[0]]
    else:
        lead = F.floor(F.col(order) / max(n, BLOCK_LINES))
    led = rows.withColumn("_lead", lead)
    sizes = led.groupBy("_lead").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(W.orderBy("_lead").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    kept = sizes.withColumn("_before", before).where(F.col("_before") < n).select("_lead")
    return led.join(kept, "_lead", "left_semi").drop("_lead").orderBy(order).limit(n)


def blend_moments(scored: DataFrame, models: Sequence[str], truth: str = "truth") -> DataFrame:
    """One row: ``n``, the sums of products of all inputs and the constant 1, and with the truth."""
    inputs = {m: F.col(m) for m in models} | {"one": F.lit(1.0)}
    names = list(inputs)
    sums = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(names):
        sums += [F.sum(inputs[a] * inputs[b]).alias(f"{a}_{b}") for b in names[i:]]
        sums.append(F.sum(inputs[a] * F.col(truth)).alias(f"{a}_y"))
    return scored.where(F.col(truth).isNotNull()).agg(*sums)


def fit_blend(
    moments: Row,
    models: Sequence[str],
    lam: float,
    bounds: Mapping[str, tuple[float, float]],
) -> Weights:
    """Solve the ridge equations of ``moments``; the constant is not penalised.

    Weights are then cut to ``bounds``, and the constant stays as solved.
    """
    names = [*models, "one"]
    size = len(names)
    lhs = np.zeros((size, size))
    for i, a in enumerate(names):
        for j in range(i, size):
            lhs[i, j] = lhs[j, i] = moments[f"{a}_{names[j]}"]
    lhs[np.diag_indices(size)] += [lam] * len(models) + [0.0]
    solved = np.linalg.solve(lhs, [moments[f"{a}_y"] for a in names])
    cut = {m: float(np.clip(w, *bounds[m])) for m, w in zip(models, solved)}
    return Weights(cut, float(solved[-1]))


def blend_score(weights: Weights) -> Column:
    total = F.lit(float(weights.constant))
    for model, weight in weights.of.items():
        total = total + F.lit(float(weight)) * F.col(model)
    return clamp(total)


def blend_predict(scored: DataFrame, weights: Weights, output: str = "prediction") -> DataFrame:
    return scored.withColumn(output, blend_score(weights))
