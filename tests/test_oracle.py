"""Every registered query against its SQL."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from oracle import connect, differences

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


SQL = entry_module.oracle_sql()


def test_every_query_has_sql():
    from tierflow.plans.queries import QUERIES

    assert set(QUERIES) <= set(SQL) <= set(entry_module.queries())


def test_entry_finds_the_known_anomalies(spark):
    assert entry_module.entry(spark).count() == 22


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    result = entry_module.queries()[name](spark, FOLDER)
    assert differences(result, duck, SQL[name]) is None
