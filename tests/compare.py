"""Rows of a Spark result and of DuckDB SQL in one comparable form."""

import datetime
import decimal
import glob
import os

import duckdb


def plain(x):
    if x is None:
        return None
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if x != x else float(f"{x:.9g}")
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    return x


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def sql_rows(sf_dir, sql):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    found = c.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
