"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from lakemart.plans.registry import build_queries
from oracle.queries import oracle_sql
from tests.compare import compare, engine

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = build_queries(), oracle_sql()
pytestmark = pytest.mark.oracle


@pytest.fixture(scope="module")
def con():
    return engine(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    assert compare(spark, con, name, FOLDER, QUERIES[name], ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_registry():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"lsa_topk"}


def test_entry(spark):
    assert entry(spark).count() > 0
