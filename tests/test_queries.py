"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry_module
from tests import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert oracle.mismatch(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).collect()


def test_entry(spark):
    assert entry_module.entry(spark).count() >= 2
