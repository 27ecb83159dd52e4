"""Compare a query with its SQL in DuckDB."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False, name=None))


def same(df, con, sql):
    a, b = df.toPandas(), con.sql(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert [str(t) for t in a[sorted(a.columns)].dtypes] == [str(t) for t in b[sorted(b.columns)].dtypes]
    assert rows(a) == rows(b)
