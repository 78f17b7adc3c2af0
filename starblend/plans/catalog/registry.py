"""The query registry and what its entries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starblend.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def space(spark: SparkSession) -> Workspace:
    """Tables of a query whose result is read later; they go when the driver ends."""
    return Workspace(spark).close_at_exit()


def r6(c: str | Column) -> Column:
    """Rounded to six places, never minus zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def sql_r6(expression: str) -> str:
    return f"(round({expression}, 6) + CAST(0 AS DOUBLE))"


def ratings_sql(item: str = "l_suppkey") -> str:
    """CTEs ``ratings``, ``train``, ``test``, ``history`` and ``held`` (the last two deduplicated)."""
    return f"""
ratings AS (
  SELECT o_custkey AS user_id, {item} AS business_id,
         CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS stars,
         l_shipdate, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
train AS (SELECT * FROM ratings WHERE (user_id * 31 + business_id * 17) % 10 <> 0),
test AS (SELECT * FROM ratings WHERE (user_id * 31 + business_id * 17) % 10 = 0),
history AS (
  SELECT user_id, business_id, stars FROM train
  QUALIFY row_number() OVER (PARTITION BY user_id, business_id
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, stars DESC) = 1
),
g AS (SELECT avg(stars) AS m FROM train)"""


def biases_sql(lam: float = 9.0, rounds: int = 4) -> str:
    """CTEs ``u1, b1, ... un, bn`` on top of ``ratings_sql``; ``un`` and ``bn`` are the result."""
    steps = ["b0 AS (SELECT DISTINCT business_id, CAST(0 AS DOUBLE) AS bi FROM history)"]
    for i in range(1, rounds + 1):
        steps.append(f"""u{i} AS MATERIALIZED (
  SELECT user_id, sum(stars - m - bi) / (CAST({lam} AS DOUBLE) + count(*)) AS bu
  FROM history JOIN b{i - 1} USING (business_id), g GROUP BY user_id)""")
        steps.append(f"""b{i} AS MATERIALIZED (
  SELECT business_id, sum(stars - m - bu) / (CAST({lam} AS DOUBLE) + count(*)) AS bi
  FROM history JOIN u{i} USING (user_id), g GROUP BY business_id)""")
    return ",\n".join(steps)
