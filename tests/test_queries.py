"""Every registered transit query with SQL text gives the rows that DuckDB gives."""

import math

import duckdb
import pandas as pd
import pytest

from raillark.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def cell(x) -> str:
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if type(x).__name__ in ("bool", "bool_"):
        return str(bool(x))
    if isinstance(x, float) or "int" in type(x).__name__ or "float" in type(x).__name__:
        return f"{round(float(x), 6) + 0.0:.6f}"
    return str(x)


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df.reindex(sorted(df.columns), axis=1)
    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    want = duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_rows_only(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0
