"""The DuckDB oracle: every statement runs, and sample keys agree with Spark."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))


@pytest.fixture(scope="module")
def con():
    from shelfcast.sources.retail_view import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_statement_runs(con):
    import __spark_entry__ as E
    sql = E.oracle_sql()
    assert len(sql) >= 60
    for key, text in sql.items():
        con.sql(text).fetchall()


@pytest.mark.parametrize("key", ["clean_transactions", "demand_weekly", "item_accuracy",
                                 "series_zscore", "ordered_target_encoding", "cleaning_audit"])
def test_sample_keys_match_spark(spark, con, key):
    import __spark_entry__ as E
    from compare import digest
    got = digest(E.queries()[key](spark, SF_SMALL).toPandas())
    want = digest(con.sql(E.oracle_sql()[key]).df())
    assert got == want
