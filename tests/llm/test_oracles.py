"""The queries that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from adlens.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [sorted(map(tuple, x[columns].itertuples(index=False, name=None)), key=repr) for x in (got, want)]
    assert rows[0] == rows[1]
