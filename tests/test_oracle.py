"""All registered queries against DuckDB, at two scales."""

import os

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from climagrid.checks.oracle import ORACLE
from climagrid.checks.queries import QUERIES

SCALES = os.environ.get("CHECK_SCALES", "sf0.001,sf0.01").split(",")


@pytest.fixture(scope="module", params=SCALES)
def tables(request):
    sf_dir = f"/root/testdata/{request.param}"
    con = compare.connect(sf_dir)
    yield sf_dir, con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, tables, name):
    sf_dir, con = tables
    assert compare.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 823
