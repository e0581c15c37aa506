import os

import duckdb
import pytest

from postings.llm import queries
from tools.compare import TABLES, canon

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.sql(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)
