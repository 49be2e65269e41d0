"""Comparison of a Spark result with DuckDB's, row by row in any order."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both have the same columns and rows."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in rel.fetchall())
    ours = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    if ours == theirs:
        return ""
    more, less = ours - theirs, theirs - ours
    return f"{sum(ours.values())} rows against {sum(theirs.values())}; ours only {list(more.items())[:3]}, theirs only {list(less.items())[:3]}"
