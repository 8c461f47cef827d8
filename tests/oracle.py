"""Run a registered query and its SQL and compare rows regardless of order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_rows, spark_columns, sql: str, con) -> str | None:
    """None if equal, else a short description of the first difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_columns):
        return f"columns {sorted(spark_columns)} != {sorted(names)}"
    mine, theirs = _rows(spark_columns, spark_rows), _rows(names, cursor.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
