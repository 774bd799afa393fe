"""Runs a registered query and its DuckDB equivalent side by side."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.6g}"
    if isinstance(value, decimal.Decimal):
        return f"{value.normalize():f}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return "null" if value is None else str(value)


def both(spark, con, query, sql, sf_dir):
    """Sorted rows of both sides, columns by name."""
    df = query(spark, sf_dir)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    order = sorted(range(len(names)), key=lambda i: names[i])
    theirs = sorted(tuple(plain(r[i]) for i in order) for r in found.fetchall())
    mine = sorted(tuple(plain(r[n]) for n in sorted(names)) for r in df.collect())
    return mine, theirs
