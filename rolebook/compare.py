"""Local version of the correctness check: Spark result against DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from rolebook.roles import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normalised(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def differences(df, connection, sql: str) -> list[str]:
    """Empty when the two results agree in columns and rows."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return [f"columns: spark only {sorted(set(df.columns) - set(columns))}, sql only {sorted(set(columns) - set(df.columns))}"]
    actual = [tuple(r) for r in df.collect()]
    left, right = normalised(actual, df.columns), normalised(expected, columns)
    problems = []
    if len(left) != len(right):
        problems.append(f"rows: spark {len(left)}, sql {len(right)}")
    if left != right:
        a, b = set(left), set(right)
        problems.append(f"columns {sorted(columns)}")
        problems += [f"spark only {r}" for r in sorted(a - b, key=str)[:3]]
        problems += [f"sql only   {r}" for r in sorted(b - a, key=str)[:3]]
    if not right:
        problems.append("no rows")
    return problems
