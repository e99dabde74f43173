"""The registered queries: names, docstrings, and SQL that the oracle's dialect reads with the same columns."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_every_query_is_described():
    assert all(f.__doc__ for f in entry.queries().values())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_columns_of_queries_and_sql_agree(spark):
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    found, sql = entry.queries(), entry.oracle_sql()
    wrong = {}
    for name, text in sql.items():
        want = sorted(r[0] for r in con.execute(f"DESCRIBE {text}").fetchall())
        have = sorted(found[name](spark, DATA).columns)
        if want != have:
            wrong[name] = (want, have)
    assert not wrong


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_the_flagship_query_has_rows(spark):
    assert entry.entry(spark).count() > 0
