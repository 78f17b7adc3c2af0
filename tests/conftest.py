from __future__ import annotations

import numpy as np
import pytest

from starblend.workspace import Workspace
from tests.session import session


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def work(spark):
    with Workspace(spark) as space:
        yield space


@pytest.fixture(scope="session")
def planted(spark):
    """Ratings with three planted factors, biases and noise, and two columns close to the item bias."""
    rng = np.random.default_rng(42)
    users, items, rank = 300, 120, 3
    p, q = rng.normal(0, 0.5, (users, rank)), rng.normal(0, 0.5, (items, rank))
    bu, bi = rng.normal(0, 0.4, users), rng.normal(0, 0.5, items)
    noise = rng.normal(0, 0.3, (users, items))
    stars = np.clip(3.4 + bu[:, None] + bi[None, :] + p @ q.T + noise, 1, 5)
    seen = rng.random((users, items)) < 0.3
    held = rng.random((users, items)) < 0.2
    side = np.stack([bi + rng.normal(0, 0.1, items), -bi + rng.normal(0, 0.1, items)], axis=1)
    rows = [
        (f"u{u:03d}", f"b{b:03d}", float(stars[u, b]), bool(held[u, b]), int(u * items + b))
        for u, b in zip(*np.nonzero(seen))
    ]
    table = spark.createDataFrame(
        rows, "user_id string, business_id string, stars double, held boolean, line long"
    )
    features = spark.createDataFrame(
        [(f"b{b:03d}", float(side[b, 0]), float(side[b, 1])) for b in range(items)],
        "business_id string, side0 double, side1 double",
    )
    table = table.selectExpr("user_id", "business_id", "stars", "held", "line AS row_id").cache()
    train = table.where("NOT held").drop("held")
    test = table.where("held").drop("held").withColumnRenamed("stars", "truth")
    return train, test, features.cache()
