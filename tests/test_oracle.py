"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from entryclime.plans.catalog import QUERIES
from entryclime.plans.oracle import ORACLE_SQL
from scripts.check_oracle import TABLES, digest, norm

#: No port has all twelve months of a year at sf0.001; at sf0.01 every query has rows.
EMPTY_ON_THE_SMALLEST = {"month_matrix", "matrix_to_series", "port_regression"}
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = norm(E.queries()[name](spark, SF_DIR).toPandas())
    want = norm(con.sql(E.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert len(got) > 0 or name in EMPTY_ON_THE_SMALLEST
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["i94port_city_code", "city", "state_code", "average_temperature", "entry_year",
                          "entry_month", "count", "rank"]
    assert df.count() > 0
