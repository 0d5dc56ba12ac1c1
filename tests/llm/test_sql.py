"""The operators' queries that SQL can express against their SQL in DuckDB, on the smallest table."""

import os

import duckdb
import pytest

from tests.test_oracle import rows
from weft.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op5_ngram_jaccard", "op8_warc", "op9_top_k"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    ours, theirs = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_sql_covers_queries_only():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
