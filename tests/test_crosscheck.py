"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from siltgate.catalog import load
from tests import crosscheck
from tests.conftest import FOLDER

QUERIES = {name: fn for name, fn in entry.queries().items() if name in load.QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in load.QUERIES}


@pytest.fixture(scope="module")
def con():
    return crosscheck.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    verdict, rows, _ = crosscheck.compare(spark, con, FOLDER, name, QUERIES[name], SQL.get(name))
    assert verdict == "match", verdict


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_state", "customer_count", "pct_of_total"]
    assert 0 < len(df.collect()) <= 10
