"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if Spark's rows and DuckDB's agree, else what is amiss."""
    cur = con.execute(sql)
    names, theirs = [c[0] for c in cur.description], cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, theirs)
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; only Spark: {list((ours - theirs).items())[:3]}; only DuckDB: {list((theirs - ours).items())[:3]}"
