"""Every catalogue query against its SQL on the given tables."""

import pytest
from oracle import check, connect

import __spark_entry__ as contract
from tradepulse.plans import catalogue

QUERIES = catalogue.queries()
SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    assert check(spark, con, QUERIES[name], SQL[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_returns_rows(con, name):
    assert con.execute(SQL[name]).fetchone() is not None


def test_entry_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:2] == ["branch", "channel"]
