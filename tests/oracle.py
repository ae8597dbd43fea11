"""A query's rows beside those of its SQL."""

from __future__ import annotations

import os

import duckdb


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_sql(sql, folder):
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{folder}/{f}')")
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(_plain(row[i]) for i in order) for row in r.fetchall()), key=repr)
