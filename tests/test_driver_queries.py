"""Every registered query against its DuckDB statement on sf0.001 (layer c).

The driver runs the same comparison at sf0.01 (``tools/oracle_check.py``)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from __spark_entry__ import QUERIES, SQL
from membra.plans.tables import TABLES
from tools.oracle_check import sorted_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["icpsr", "congress", "groups_a", "positions", "bioguide",
                          "groups_b", "titles"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    sc, sr = sorted_rows(df.columns, df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    dc, dr = sorted_rows(rel.columns, rel.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
