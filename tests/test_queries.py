"""Every registered query against its SQL on the whole small tables."""

import pytest

import __spark_entry__ as contract
import compare
from registry import queries as registered
from conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, connection, name):
    assert compare.compare(spark, connection, SMALL, name) == ""


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
