"""Every query against its SQL oracle."""

import os

import pytest

import oracles
from beaconfold.plans import queries as catalogue
from tests.compare import duck, duck_result, spark_result

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalogue.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got_columns, got = spark_result(QUERIES[name](spark, SF_DIR))
    want_columns, want = duck_result(con, ORACLES[name])
    assert got_columns == want_columns
    assert sum(want.values()) > 0
    assert got == want
