"""The SQL of the operators that SQL can express, run in DuckDB at sf0.01."""

import os

import duckdb
import pytest

from helpers import ordered
from shelfcast.llm.queries import oracle_sql, queries

SF_MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_spark_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF_MID):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF_MID}/{f}'")
    got = queries()[name](spark, SF_MID)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]}) q").fetchall()
    assert ordered(got.select(*columns).collect()) == ordered(want) and want
