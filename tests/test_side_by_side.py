"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
import side_by_side

import __spark_entry__ as entry
from curbline.workload import catalogue

QUERIES = catalogue.QUERIES
ORACLES = catalogue.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return side_by_side.duck(sf)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf, name):
    problem, _, _ = side_by_side.compare(spark, con, name, QUERIES[name], ORACLES[name], sf)
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
