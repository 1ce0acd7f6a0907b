"""Every registered query against its SQL, on the smallest test data."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract
from clickloom.catalog import oracle, queries as registered

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


def test_every_query_has_sql():
    assert registered.queries().keys() == oracle.oracle_sql().keys()
    assert registered.queries().items() <= contract.queries().items()


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, connection, name):
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    rows, problem = compare(spark, connection, query, sql, DATA)
    assert not problem
    assert rows > 0 or name == "session_filter_full"


def test_flagship(spark):
    assert contract.entry(spark).count() == 1
