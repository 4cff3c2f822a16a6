"""Driver contract: entry() and every queries() entry against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from adlens.plans.catalog import QUERIES
from fixtures_small import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["provincename", "cityname"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null",)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", repr(float(v)))
    return ("s", str(v))


def _canon(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(want)
