"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from millrace.catalog import load
from tests.helpers import plan
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SQL = {name: e.sql for name, e in load().items()}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert all(SQL.values()) and set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, no_broadcasts, con, name):
    df = entry.queries()[name](spark, SF)
    text = plan(df)
    assert not [word for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "FlatMapGroups") if word in text]
    problems, _ = compare(df, SQL[name], con)
    assert not problems, problems


def test_entry(spark):
    df = entry.entry(spark)
    assert "rfm_segment" in df.columns and df.count() > 0
