"""Runs a query and its SQL side by side on one directory of tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SF = os.environ.get("TEST_SF", "/root/testdata/sf0.01")


def connect(sf: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return con


def plain(value: object) -> str:
    if isinstance(value, float) and not math.isnan(value):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def normal(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result, at most a few rows of each side."""
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normal(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} and {sorted(names)}")
    if got != want:
        a, b = set(got), set(want)
        out.append(f"{len(got)} and {len(want)} rows; only Spark {sorted(a - b)[:3]}; only SQL {sorted(b - a)[:3]}")
    return out
