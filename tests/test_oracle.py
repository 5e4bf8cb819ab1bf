"""Every registered query with SQL gives the rows DuckDB gives on the same tables."""

import os

import pytest
from oracle import compare, duck

from commentflow.plans.catalog import REGISTRY

SF_DIR = os.environ.get("COMMENTFLOW_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.filterwarnings("ignore:no predictions")
@pytest.mark.parametrize("key", [k for k, q in REGISTRY.items() if q.sql])
def test_query_equals_sql(spark, con, key):
    query = REGISTRY[key]
    assert compare(query(spark, SF_DIR), con, query.sql) == []


@pytest.mark.parametrize("key", [k for k, q in REGISTRY.items() if not q.sql])
def test_query_without_sql_runs(spark, key):
    df = REGISTRY[key](spark, SF_DIR)
    assert df.columns and df.count() > 0
