"""Registered queries over the star-schema tables, each with its SQL check where SQL can state it."""

from __future__ import annotations

from starblend.plans.catalog import cleaning, feature_rows, io, models, profiles  # noqa: F401
from starblend.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
