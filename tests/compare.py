"""Comparison of a Spark result with its oracle in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

KINDS = {
    "bigint": "bigint",
    "int": "integer",
    "double": "double",
    "string": "varchar",
    "boolean": "boolean",
}


def oracle_connection(base: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{base}/{table}.parquet").exists():
            connection.execute(f"create view {table} as select * from read_parquet('{base}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def ordered(rows) -> list[tuple]:
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def spark_result(df):
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    return [(n, KINDS.get(kinds[n], kinds[n])) for n in names], ordered(df.select(*names).collect())


def oracle_result(connection, sql: str):
    cursor = connection.execute(f"select * from ({sql}) q")
    columns = [(c[0], str(c[1]).lower()) for c in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i][0])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return [columns[i] for i in order], ordered(rows)


def difference(df, connection, sql: str) -> str | None:
    """None when columns, types and rows agree; otherwise what differs."""
    columns, rows = spark_result(df)
    expected_columns, expected = oracle_result(connection, sql)
    if columns != expected_columns:
        return f"columns {columns} <> {expected_columns}"
    if rows == expected:
        return None
    extra = [r for r in rows if r not in set(expected)][:3]
    missing = [r for r in expected if r not in set(rows)][:3]
    return f"{len(rows)} rows <> {len(expected)}; only Spark {extra}; only oracle {missing}"
