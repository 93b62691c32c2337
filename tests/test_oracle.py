"""Every registered query against its SQL, on the smallest data."""

import pytest

from emberlog.plans import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
