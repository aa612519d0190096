"""Every query of the catalogue against its SQL twin."""

import pytest
from compare import connect, differences, run_sql

import __spark_entry__ as entry_points
import oracles
from barloom.plans.catalog import catalog

QUERIES = catalog()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toArrow()
    assert differences(got, run_sql(con, ORACLES[name])) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() == 75
