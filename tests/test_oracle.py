"""Every query with an SQL form gives the same rows as DuckDB."""

import __spark_entry__ as entry_module
import compare
import pytest

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return compare.connect(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, folder, duck, name):
    assert compare.difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_entry(spark):
    row = entry_module.entry(spark).first()
    assert row["n"] > 0 and row["rmse"] >= row["mae"] > 0
