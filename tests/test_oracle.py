"""Every registered query of the reference's operators against its SQL in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from weft.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)].astype(object).where(df.notna(), None)
    return sorted(map(tuple, df.values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, SF).toPandas(), duck.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
