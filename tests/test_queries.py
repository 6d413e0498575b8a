"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

from checks.compare import connect, differences
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, SF_DIR, name, connection)[1] == []
