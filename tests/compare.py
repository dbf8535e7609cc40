"""Compare Spark results with DuckDB over the same tables, as multisets of rows with columns in name order."""

from __future__ import annotations

import datetime as dt
import glob
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, bytes)):
        return value
    if isinstance(value, (float, Decimal)):
        return round(float(value), 9)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def multiset(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in table)


def spark_result(df):
    return df.columns, multiset(df.columns, df.collect())


def duck_result(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, multiset(columns, cursor.fetchall())


def differences(df, con, sql, show=3):
    """Empty string when both sides agree, else what differs."""
    spark_columns, ours = spark_result(df)
    duck_columns, theirs = duck_result(con, sql)
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns {sorted(spark_columns)} != {sorted(duck_columns)}"
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; only Spark {list(only_ours)[:show]}; "
            f"only SQL {list(only_theirs)[:show]}"
        )
    return ""
