"""Every query with SQL gives that SQL's rows, on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from lattix import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return made


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value if value is None or isinstance(value, (bool, int, str)) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(r[k]) for k in order) for r in rows)


def differences(name, query, sql, spark, con):
    df, told = query(spark, SF), con.sql(sql)
    assert sorted(df.columns) == sorted(told.columns), name
    return rows_of(df.columns, df.collect()) == rows_of(told.columns, told.fetchall())


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_rows_are_those_of_the_sql(name, spark, con):
    assert differences(name, plans.QUERIES[name], plans.ORACLE_SQL[name], spark, con)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_queries_without_sql_give_rows(name, spark):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_the_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
