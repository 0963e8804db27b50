"""Every query of the library against its SQL."""

from __future__ import annotations

import pytest
from framewright import queries
from tests.oracle import SF_DIR, assert_same


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_matches_sql(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLE[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["frame_idx", "image_idx", "image_name"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stride_sample_has_no_exchange_and_reads_one_column(spark):
    plan = queries.frame_stride_sample(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<event_id:bigint>" in plan
