"""Run a registered query and its check SQL on the same files and compare all values."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plained = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plained, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def difference(spark, con, fn, sql: str, folder: str) -> str | None:
    """None when equal, else a short description."""
    df = fn(spark, folder)
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    other = table([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != other[0]:
        return f"columns {mine[0]} != {other[0]}"
    if len(mine[1]) != len(other[1]):
        return f"{len(mine[1])} rows != {len(other[1])} rows"
    for a, b in zip(mine[1], other[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(c, x, y) for c, x, y in zip(mine[0], a, b) if x != y or type(x) is not type(y)]
            count = sum(1 for x, y in zip(mine[1], other[1]) if x != y)
            return f"{count} rows differ, first: {bad}"
    return None
