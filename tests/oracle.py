"""Compare a query with its SQL in DuckDB on one data folder."""

import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return tuple(map(canon, v)) if isinstance(v, (list, tuple)) else v


def same(df, con, sql):
    cols = sorted(df.columns)
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    got = Counter(tuple(canon(x) for x in row) for row in df.select(*[f"`{c}`" for c in cols]).collect())
    want = Counter(tuple(canon(row[i]) for i in at) for row in r.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
