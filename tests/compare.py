"""Compare a Spark result with the DuckDB result of its SQL twin."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(out, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences; empty when both results are equal."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = rows(names, cur.fetchall())
    got_cols, got = rows(df.columns, df.collect())
    if want_cols != got_cols:
        return [f"columns differ: spark {got_cols}, sql {want_cols}"]
    if len(want) != len(got):
        return [f"row counts differ: spark {len(got)}, sql {len(want)}"]
    bad = [f"spark {g}\n  sql {w}" for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    return bad[:5]
