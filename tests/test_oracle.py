import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import oracle  # noqa: E402

from spanweave.plans import catalog  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_duckdb(spark, con, name):
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert catalog.queries()[name](spark, SF_DIR).count() > 0
        return
    mine, theirs = oracle.both(spark, con, catalog.queries()[name], sql, SF_DIR)
    assert mine == theirs
