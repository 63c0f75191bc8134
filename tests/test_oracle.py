"""Every named query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry
from retailgrain.checks import CHECKS

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(CHECKS))
def test_same_rows(spark, sf_dir, con, name):
    got_columns, got = spark_rows(QUERIES[name](spark, sf_dir))
    want_columns, want = sql_rows(con, SQL[name])
    assert got_columns == want_columns
    assert got == want
    assert sum(got.values()) > 0
