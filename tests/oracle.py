"""Run a query and its SQL side by side and compare the rows."""

import datetime
import glob
import math
import os

import duckdb


def tables(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{src}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=repr)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    want = rows(names, cur.fetchall())
    assert len(got) == len(want), (len(got), len(want), got[:3], want[:3])
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not bad, (len(bad), bad[:3])
    return len(got)
