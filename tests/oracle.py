"""Compare a query with its SQL twin on the same tables."""

from __future__ import annotations

import collections
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), _bag(df.columns, [tuple(r) for r in df.collect()])


def sql_bag(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(names), _bag(names, cur.fetchall())


def differences(df, con, sql):
    """None when equal, else a short text."""
    names, ours = spark_bag(df)
    sql_names, theirs = sql_bag(con, sql)
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} rows vs {sum(theirs.values())}; "
            f"only ours {str(list(extra)[:2])[:600]}; only theirs {str(list(missing)[:2])[:600]}"
        )
    return None
