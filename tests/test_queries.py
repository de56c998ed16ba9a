"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from gaugeflow.plans.catalog import load

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = load()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, problems = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_DIR)
    assert rows >= 0
    assert not problems, problems


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["action", "reason", "ds_id", "phen_start", "result_num"]
    assert df.count() > 0


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
