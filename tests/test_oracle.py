"""Every registered query against its DuckDB statement on the smallest test tables."""

from pathlib import Path

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from remitmatch.harness.oracles import ORACLE
from remitmatch.harness.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    assert {r.match_type for r in entry.entry(spark).collect()} >= {"SINGLE_MATCH"}
