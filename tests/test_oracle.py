"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from surveylake.bindings import all_registries
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for part in all_registries() for name, query in part.queries.items()}
ORACLES = {name: sql for part in all_registries() for name, sql in part.oracles.items()}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    problems, _ = differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert problems == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
