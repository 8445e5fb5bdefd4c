"""Compare a Spark result with a DuckDB oracle by value (test helper).

Columns are matched by name; rows are compared as sorted multisets of
canonical values (floats by repr, dates and timestamps by ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb

from snapmart.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def canon(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, repr(float(v)))
    if isinstance(v, int):
        return (3, str(v))
    if isinstance(v, decimal.Decimal):
        return (2, repr(float(v)))
    if isinstance(v, (dt.datetime, dt.date)):
        return (4, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (5, repr([canon(x) for x in v]))
    if isinstance(v, dict):
        return (6, repr(sorted((k, canon(x)) for k, x in v.items())))
    return (7, str(v))


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(canon(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(canon(r[i]) for i in order) for r in data]
    return cols, sorted(rows)


def compare(df, con, sql):
    """Return None when equal, else a short description of the difference."""
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return f"columns differ: spark={s_cols} duckdb={d_cols}"
    if len(s_rows) != len(d_rows):
        return f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return f"first differing row: spark={a} duckdb={b}"
    return None
