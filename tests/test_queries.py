import os

import duckdb
import pytest

from postings import queries
from tools.compare import TABLES, canon

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sql, name):
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), sql.sql(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_sanitised_pages_are_safe(spark):
    rows = queries.sanitised_pages(spark, DATA)
    assert rows.where("not safe").count() == 0
