"""The driver contract: entry() smoke run, and every registered query against its
DuckDB twin on the smallest test tables (column names, row count, values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from cofan.sources.testdata import TABLES
from tools_check import compare, type_diffs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["movieId", "title", "genres", "fan_rating_count"]
    assert df.count() >= 0


def test_every_sql_query_has_a_spark_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    rel = duck.execute(E.oracle_sql()[name])
    msg = compare(rows, cols, rel.fetchall(), [d[0] for d in rel.description])
    assert msg is None, msg
    assert not type_diffs(df.schema, rel.description)
