"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OWN = entry._registered()
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
