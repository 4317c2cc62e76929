"""Every registered query against its oracle on the smallest scale."""

from __future__ import annotations

import os

import pytest

from fleetwatch.queries import load
from fleetwatch.queries.check import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duck(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("key", sorted(load()))
def test_query_matches_oracle(spark, con, key):
    problem = compare(spark, con, load()[key], SF_DIR)
    assert problem in (None, "EMPTY"), problem
