"""Comparison of a query with its SQL in DuckDB, cell by cell and without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(_plain(x) for x in v)
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*' if p.is_dir() else ''}')")
    return con


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    cols = sorted(df.columns)
    ours = sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(sql)
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    theirs = sorted((tuple(_plain(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=repr)
    assert ours == theirs
