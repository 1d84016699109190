"""Every query that SQL can express, against DuckDB on the smallest tables."""

import os

import pytest

import check
from tidemark.plans import load_all
from tidemark.plans.registry import ORACLES, QUERIES

PATH = "/root/testdata/sf0.001"
load_all()
# with 150 accounts no list of a fixed length is guaranteed to be filled
pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return check.connect(PATH)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    ok, message = check.compare(QUERIES[name](spark, PATH), con, ORACLES[name])
    assert ok, message
    assert "types" not in message, message


def test_entry_has_rows(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
