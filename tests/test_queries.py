"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from parcelflow.plans import registry
from tests.compare import database, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, connection, name):
    assert difference(spark, connection, SMALL, name) is None


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[:2] == ["month", "batch_id"] and not rows.isEmpty()


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(registry.QUERIES) <= set(contract.oracle_sql())
