"""Every query with SQL text gives the rows that DuckDB gives."""

import duckdb
import pytest

from raillark.llm import queries
from tests.test_queries import rows

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
