"""Runs SQL beside a query, on the tables of a test scale."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _key(row: tuple) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def assert_same(spark, query, sql: str, sf_dir: str = SF_DIR) -> None:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_key)
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=_key)
    assert list(map(_key, got)) == list(map(_key, want))
