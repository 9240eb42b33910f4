"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry
from tools.check_oracle import TABLES, rows_of

# Full grids on 2,000 rows take minutes; test_models.py runs the same code on small grids. tree_cv is run here.
SLOW = {"forest_cv", "gbt_cv", "logreg_cv", "tuning_table", "mlp_sweep"}


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '/root/testdata/sf0.001/{table}.parquet'")
    return con


def test_names():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_a_part_that_cannot_be_imported_is_left_out():
    with pytest.warns(UserWarning, match="left out"):
        assert registry._optional("no_such_module") is None


def test_entry(spark):
    assert registry.entry(spark).count() == 1


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in SLOW])
def test_query(spark, duck, small, name):
    df = registry.queries()[name](spark, small)
    got = rows_of(df.columns, df.collect())
    assert got
    sql = registry.oracle_sql().get(name)
    if sql:
        result = duck.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, result.fetchall())
