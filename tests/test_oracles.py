"""Every query with an oracle gives the oracle's rows on the smallest test set."""

import os

import pytest

from checks.compare import connect, difference
from checks.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not there")
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, con, name):
    rows, found = difference(spark, con, QUERIES[name], ORACLES[name], SF)
    assert found is None and rows > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
