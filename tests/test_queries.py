"""Every registered query against its SQL twin."""

import oracle
import pytest

import __spark_entry__ as entry_point
from threadloom.bindings.queries import QUERIES as CORE

# The library's own; the optional subpackage tests its queries itself.
QUERIES = {name: entry_point.queries()[name] for name in CORE}
SQL = {name: entry_point.oracle_sql()[name] for name in CORE if name in entry_point.oracle_sql()}


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    assert oracle.differences(QUERIES[name](spark, small), con, SQL[name]) is None


def test_entry_runs(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["external_id", "SD_output", "SD_label"]
    assert df.count() > 0
