"""Compare a Spark result with the DuckDB result of its SQL twin."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(value) -> str:
    return type(value).__name__


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def compare(con, sql: str, df) -> list[str]:
    """Differences as text; empty means equal names, types, rows and values."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    actual = df.collect()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    if len(expected) != len(actual):
        problems.append(f"rows {len(actual)} <> {len(expected)}")
    spark_types = {c: t for c, t in df.dtypes}
    duck_types = {d[0]: str(d[1]).upper() for d in result.description}
    pairs = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    for c, t in spark_types.items():
        if pairs.get(t, t) != duck_types[c]:
            problems.append(f"type of {c}: {t} <> {duck_types[c]}")
    a, b = rows_of(df.columns, actual), rows_of(names, expected)
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return problems
