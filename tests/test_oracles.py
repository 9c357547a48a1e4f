"""Every registered query against its SQL oracle on whole tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    run = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert run(spark, FOLDER).count() > 0
        return
    count, wrong = compare(spark, con, FOLDER, run, sql)
    assert not wrong
    assert count > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["period", "channel", "revenue", "units"]
