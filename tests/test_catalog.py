"""Every catalogue query that has an expected-result SQL agrees with it."""

import pytest

import __spark_entry__ as driver
from conftest import SF_DIR, assert_no_all_pairs_join, assert_same, duck
from sessionloom.plans.catalog import all_queries
from sessionloom.plans.oracle import all_oracles

QUERIES, EXPECTED = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck()


def test_every_expected_result_has_a_query():
    assert set(EXPECTED) <= set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_matches_expected(name, spark, con):
    df = QUERIES[name](spark, SF_DIR)
    assert_no_all_pairs_join(df)
    assert_same(df, EXPECTED[name], con)


def test_flagship_runs(spark):
    assert driver.entry(spark).count() > 0
