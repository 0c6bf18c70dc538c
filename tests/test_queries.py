"""Every registered query against its SQL on the smallest tables."""

import pytest

from registry import ORACLES, QUERIES
from registry.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    diff, _ = differences(spark, con, sf, name)
    assert not diff, diff


def test_checks_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
