"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from cartledger.checks import registry
from cartledger.checks.compare import differences
from cartledger.checks.oracle import oracle_sql

# The corpus operators have tests of their own.
QUERIES = registry.queries()

# The two reports with a minimum number of orders per state have no rows this small.
EMPTY_WHEN_SMALL = {"q04_customers_by_state", "q10_freight_by_state"}


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(driver.oracle_sql()) >= set(QUERIES)
    assert set(driver.queries()) >= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    rows, problems = differences(spark, name, sf_dir)
    assert not problems, problems
    assert rows or name in EMPTY_WHEN_SMALL
