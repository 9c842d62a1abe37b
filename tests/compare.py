"""Run a registered query and its SQL side by side and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)) and not hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(sorted((k, plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normal(columns, cursor.fetchall())


def difference(left, right, show=3):
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}"
    if left[1] == right[1]:
        return None
    a, b = set(map(repr, left[1])), set(map(repr, right[1]))
    only_a, only_b = sorted(a - b), sorted(b - a)
    return f"rows {len(left[1])} vs {len(right[1])}; spark only {len(only_a)} {only_a[:show]}; sql only {len(only_b)} {only_b[:show]}"
