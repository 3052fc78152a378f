"""Every named query against its SQL oracle on the smallest tables."""

import pytest
from oracle_check import connect, differences
from sample_tables import SMALL

from weirflow.plans import ORACLES, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []
