"""Every registered query against its SQL on the given tables."""

import pytest

from tallyline.catalog import ORACLES, QUERIES
from tests.harness import compare, connect


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, folder, name):
    assert compare(spark, duck, folder, name, QUERIES, ORACLES) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
