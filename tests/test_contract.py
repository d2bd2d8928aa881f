"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_queries import TABLES, rows_of

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns[-2:] == ["risk_score", "risk_band"] and df.count() == 100


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = db.execute(SQL[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    """Every column is computed: a count alone would leave the scores out."""
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    assert not df.isEmpty()
