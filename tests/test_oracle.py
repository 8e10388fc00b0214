"""Every registered query against its SQL, on the smallest folder of the given tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from starloom.plans import oracle, queries as registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(registry.registered()) == set(SQL)
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    assert differences(entry.queries()[name](spark, FOLDER), duck, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["year", "month", "month_name"]
