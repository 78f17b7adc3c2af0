"""Run registered queries next to their SQL checks on the same tables."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()

SAME_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, query, sql, folder) -> list[str]:
    """What differs between the two results; empty when they match."""
    found = query(spark, folder)
    mine = _rows(found.columns, [tuple(r) for r in found.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    problems = []
    if sorted(columns) != sorted(found.columns):
        problems.append(f"columns {sorted(found.columns)} against {sorted(columns)}")
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} against {len(theirs)}")
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    kinds = {c: k for c, k in found.dtypes}
    for column in con.execute(f"DESCRIBE {sql}").fetchall():
        if SAME_TYPE.get(column[1]) != kinds.get(column[0]):
            problems.append(f"type of {column[0]}: {kinds.get(column[0])} against {column[1]}")
    return problems


def main(folder: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from tests.session import session

    spark = session()
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problems = differences(spark, con, queries[name], oracles[name], folder)
                verdict = "ok" if not problems else f"DIFFERS {problems}"
            else:
                verdict = f"{queries[name](spark, folder).count()} rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
