"""Every query with SQL gives the same rows on Spark and on DuckDB."""

import pytest

from tests.compare import difference, duck
from workload.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
