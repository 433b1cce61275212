"""Compare a Spark result with SQL run by DuckDB on the same parquet."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimals are not used in any result")
    if isinstance(value, float):
        return ("double", repr(value))
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return normal_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return normal_rows([d[0] for d in result.description], result.fetchall())
