"""Every registered query against its independent SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, connect
from tallyline.plans.catalogue import QUERIES
from tallyline.plans.oracle import ORACLE

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test data absent")


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, DIRECTORY)
    assert ok, note


def test_every_oracle_has_a_query_and_few_queries_lack_one():
    names, oracle = set(entry_module.queries()), set(entry_module.oracle_sql())
    assert oracle <= names
    assert set(QUERIES) - set(ORACLE) == {"train_select", "score_base", "worklist", "permutation_importance"}


def test_entry_returns_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["category", "revenue", "cost", "profit", "margin_pct"] and df.count() == 6
