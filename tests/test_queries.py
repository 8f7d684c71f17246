"""Every registered query against its check SQL on whole tables."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.oracle import connect, differences

SF_DIR = os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, duck, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
