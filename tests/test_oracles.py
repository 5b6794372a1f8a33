"""Every registered query against its SQL, or for at least one row where there is no SQL."""

import pytest

from tests.oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    run = queries()[name]
    if name in SQL:
        assert compare(spark, con, SF, name, run, SQL[name]) is None
    else:
        assert run(spark, SF).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    row = entry(spark).first()
    assert row["rmse"] > 0
