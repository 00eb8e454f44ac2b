"""Queries with SQL give its rows."""

import duckdb
import pytest

from lattix.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_rows_are_those_of_the_sql(name, spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, told = catalog.QUERIES[name](spark, SF), con.sql(catalog.ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(told.columns)
    assert sorted(map(repr, ([r[c] for c in order] for r in df.collect()))) == sorted(map(repr, ([r[told.columns.index(c)] for c in order] for r in told.fetchall())))
