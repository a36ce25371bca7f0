"""Every registered query against its DuckDB statement on the driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck
from refyield.plans.catalog import QUERIES
from refyield.plans.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE_SQL) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["search_domain", "search_keyword", "revenue"]
    assert df.count() >= 0


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF_DIR)
    assert ok, msg
