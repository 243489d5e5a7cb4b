"""Query results against DuckDB on the same files, as sorted rows of text."""

import decimal
import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        path = path + "/*.parquet" if os.path.isdir(path) else path
        if glob.glob(path):
            db.execute(f"create view {t} as select * from read_parquet('{path}')")
    return db


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, sf, query, sql):
    got = query(spark, sf)
    cursor = connect(sf).execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    have = rows_of(got.columns, [tuple(r) for r in got.collect()])
    assert have[0] == want[0]
    assert len(have[1]) == len(want[1]), (len(have[1]), len(want[1]))
    bad = [(a, b) for a, b in zip(have[1], want[1]) if a != b]
    assert not bad, bad[:2]
    return len(want[1])
