"""Compare a Spark DataFrame with a DuckDB query (order-free, doubles to 6 places)."""

import datetime as dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(int(v)))
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{round(v, 6):.6f}")
    if isinstance(v, int):
        return (3, str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return (4, v.isoformat())
    return (6, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def same(df, con, sql):
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols), (cols, dcols)
    a, b = canon(cols, srows), canon(dcols, drows)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b
    return len(a)
