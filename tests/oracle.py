"""Rows of a Spark query against rows of DuckDB SQL, without order."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet" + ("/*" if os.path.isdir(f"{sf_dir}/{t}.parquet") else "")
        con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.6g}"
    return str(v)


def same(df, con, sql):
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    a = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in got)
    at = [names.index(c) for c in sorted(names)]
    b = sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    assert a == b
