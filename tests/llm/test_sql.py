"""Queries that SQL can express, against their SQL; and all queries over empty tables."""

from __future__ import annotations

import pytest
from framewright.llm import registry
from tests.llm.data import documents, empty_folder, folder
from tests.oracle import assert_same


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_query_matches_sql(spark, name):
    assert_same(spark, registry.QUERIES[name], registry.ORACLE[name])


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls, ties and extra columns; without the rows that repeat an id, which the SQL does not tell apart."""
    rows, seen = [], set()
    for r in documents():
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    path = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(rows, __import__("tests.llm.data", fromlist=["SCHEMA"]).SCHEMA).coalesce(1).write.parquet(str(path / "d"))
    (next((path / "d").glob("*.parquet"))).rename(path / "documents.parquet")
    for t in "region nation customer supplier part orders lineitem events embeddings pages benchmark labels conversations".split():
        (path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    return str(path)


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_query_matches_sql_on_odd_rows(spark, odd, name):
    assert_same(spark, registry.QUERIES[name], registry.ORACLE[name], odd)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    df = registry.QUERIES[name](spark, empty_folder(spark, tmp_path))
    assert df.count() == 0 and df.columns


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in ("op5_license_scan", "op7_string_tiling")])
def test_a_row_for_each_row(spark, tmp_path, name):
    rows = documents()
    assert registry.QUERIES[name](spark, folder(spark, tmp_path, rows)).count() == len(rows)
