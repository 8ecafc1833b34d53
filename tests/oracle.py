"""A query beside its SQL on the same tables."""

import glob
import os

import duckdb

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


def plain(x):
    return repr(round(x, 6)) if isinstance(x, float) else repr(x)


def same(spark, query, sql):
    df = query(spark, SF)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    rel = tables().sql(sql)
    assert sorted(rel.columns) == names
    at = [rel.columns.index(n) for n in names]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
