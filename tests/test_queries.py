"""Every registered query against its oracle, at the smallest scale."""

import duckdb
import pandas as pd
import pytest

from obslog.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def told(v):
    if pd.isna(v):
        return ""
    if isinstance(v, float) and v == int(v):
        v = int(v)
    return str(v).removesuffix(" 00:00:00")


def rows(df):
    return sorted(tuple(told(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE_SQL[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.df()
    assert {c: TYPES[t] for c, t in got.dtypes} == kinds
    assert rows(got.toPandas()) == rows(want)
