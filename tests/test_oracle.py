"""Every registered query against its DuckDB oracle on the smallest tables
(same comparison as tools/check_oracle.py)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import registry
from tools.check_oracle import TABLES, digest

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert key in SQL, f"no oracle for {key}"
    rel = con.sql(SQL[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["o_custkey", "trade_date", "value_total", "num_trades", "prev_value", "pct_change"]
    assert df.count() <= 20
