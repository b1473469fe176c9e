"""A DuckDB of a Python worker's own, in memory."""

from __future__ import annotations

import duckdb
import pyarrow as pa


def connect(memory: str = "200MB") -> duckdb.DuckDBPyConnection:
    """One thread, a memory limit, and nothing written to the machine's disk."""
    con = duckdb.connect(config={"threads": 1, "memory_limit": memory})
    con.execute("SET preserve_insertion_order = false")
    con.execute("SET temp_directory = ''")
    return con


def query(con: duckdb.DuckDBPyConnection, sql: str, **tables: pa.Table) -> pa.Table:
    """The result of a statement over some Arrow tables."""
    for name, table in tables.items():
        con.register(name, table)
    try:
        return con.sql(sql).to_arrow_table()
    finally:
        for name in tables:
            con.unregister(name)
