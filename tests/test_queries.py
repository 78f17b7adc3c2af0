"""Every registered query against its SQL check on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from starblend.plans.catalog import models
from tests.compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module", autouse=True)
def few_trees():
    """The pipeline runs with few small trees and factors here; registered, it takes its presets as they are."""
    models.CHANGES.update({"trees": 3, "depth": 3, "rank": 4, "latent_rounds": 2})
    yield
    models.CHANGES.clear()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], FOLDER) == []


LOOSE = sorted(set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", LOOSE)
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert {"bias", "cf", "latent", "boosted", "prediction"} <= set(rows.columns)
    assert rows.where("prediction NOT BETWEEN 1 AND 5").count() == 0 < rows.count()
