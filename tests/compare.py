"""Run a registered query and its oracle on the same tables and compare the rows exactly."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(canonical(r[i]) for i in order) for r in data], key=repr)


def compare(spark, con, folder: str, run, sql: str) -> tuple[int, list]:
    """Row count and the first differences (empty when equal)."""
    df = run(spark, folder)
    left_columns, left = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right_columns, right = rows([d[0] for d in cursor.description], cursor.fetchall())
    if left_columns != right_columns:
        return len(left), [("columns", left_columns, right_columns)]
    if len(left) != len(right):
        extra = [r for r in left if r not in set(right)][:3], [r for r in right if r not in set(left)][:3]
        return len(left), [("row count", len(left), len(right), *extra)]
    return len(left), [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(y) for y in b]][:3]
