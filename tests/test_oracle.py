"""Every registered query against its SQL, on the whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = registered.oracle_sql()
QUERIES = {name: query for name, query in registered.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    # The training-data queries are tested where they live.
    without = set(registered.queries()) - set(SQL)
    assert all(name == "pipeline" or name.startswith("op") for name in without)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    found = oracle.differences(QUERIES[name], SQL[name], spark, connection, SF_DIR)
    assert found is None, found


def test_entry_returns_rows(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["data", "qtd_vendas", "total_faturado", "ticket_medio"]
    assert frame.count() > 0
