"""Compare a Spark result with DuckDB's: row count, column names, unordered values."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def assert_same(df, sql, sf_dir):
    con = connect(sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(names) == sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(map(plain, r)) for r in got), key=key) == sorted((tuple(map(plain, r)) for r in want), key=key)
