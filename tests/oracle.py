"""Compare a Spark result with a DuckDB query, the way the driver's check does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\0NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), cols, hashlib.sha256("\x1e".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s = digest(spark_df.columns, s_rows)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d = digest(d_cols, cur.fetchall())
    return s, d
