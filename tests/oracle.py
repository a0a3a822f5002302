"""Compare registered queries with DuckDB: names, row counts and values."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return "null" if value is None else f"{type(value).__name__}:{value}"


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    ours = sorted(tuple(_plain(r[n]) for n in order) for r in df.select(*order).collect())
    theirs = sorted(tuple(_plain(r[names.index(n)]) for n in order) for r in expected)
    problems = []
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:3]
        only_theirs = [r for r in theirs if r not in set(ours)][:3]
        problems.append(f"only ours {only_ours}, only theirs {only_theirs}")
    return problems
