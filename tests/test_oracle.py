"""Every registered query against its SQL in DuckDB, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
from verification import catalog
from verification.check import TABLES, rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    cur = con.execute(contract.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "posicao" and df.count() == 25
