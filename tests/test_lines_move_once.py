"""The cleaning chain moves the lines through one shuffle of its own, whatever the small tables' sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators import cleaning as C
from shelfcast.operators import matching as M
from shelfcast.plans import catalog
from shelfcast.session import small_side
from shelfcast.sources import retail_transactions, retail_view
from shelfcast.sources.retail_view import ORDER_COLUMNS, load_tables


@pytest.fixture(scope="module")
def segments(spark):
    import shelfcast.plans.cleaning as PC
    captured, orig = {}, PC.materialize

    def capture(df, name, how="parquet"):
        captured[name] = df
        return orig(df, name, how)

    PC.materialize = capture
    try:
        catalog.clean(spark, SF_SMALL)
    finally:
        PC.materialize = orig
    return captured


@pytest.mark.parametrize("name, shuffles", [("clean-a", 1), ("clean-b", 0)])
def test_lines_are_not_shuffled_for_small_tables(segments, name, shuffles):
    plan = segments[name]._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan, plan
    executed = segments[name]._jdf.queryExecution().executedPlan().toString()
    assert executed.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == shuffles, executed


def test_netting_reads_written_lines(segments):
    # the view's joins run once, for the landed table
    assert "lineitem" not in segments["clean-a"]._jdf.queryExecution().executedPlan().toString()


def test_order_is_that_of_all_ordering_columns(spark):
    t = load_tables(spark, SF_SMALL, ("lineitem", "orders"))
    copies = t["lineitem"].withColumn("dup", F.lit(0)).unionByName(t["lineitem"].where("l_orderkey % 50 = 0").withColumn("dup", F.lit(1)))
    full = copies.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(*ORDER_COLUMNS)
    want = [(r.o_orderdate, r.l_orderkey) for r in full.orderBy(*ORDER_COLUMNS).collect()]
    view = retail_transactions(spark, SF_SMALL)
    assert view.schema["row_order"].dataType.names == ["o_orderdate", "l_orderkey", "n_line"]
    got = [r.row_order for r in view.select("row_order").orderBy("row_order").collect()]
    assert [(o.o_orderdate, o.l_orderkey) for o in got] == want
    assert len(set(got)) == full.distinct().count()


def test_first_sale_with_a_null_in_the_order(spark):
    day = dt.datetime(2010, 12, 1)
    rows = [("1", "s", 5, "c", (day, 1)), ("2", "s", 5, "c", (None, 9)), ("3", "s", 5, "c", (None, 8)), ("C4", "s", -5, "c", (day, 0)),
            ("5", "t", 2, None, (day, 3)), ("6", "t", 2, None, (day, 2)), ("C7", "t", -2, None, (None, 1))]
    df = C.flag_cancelled(spark.createDataFrame(rows, "invoice_id string, stock_code string, qty int, customer_id string, row_order struct<d: timestamp, k: int>"))
    for cut in (None, "parquet"):
        pairs = {(p.cancelled_invoice, p.matching_invoice) for p in M.cancellation_pairs(df, cut=cut).collect()}
        assert pairs == {("C4", "3"), ("C7", "6")}  # nulls come first
        assert {r.invoice_id for r in M.net_cancellations(df, cut=cut).collect()} == {"1", "2", "5"}


def test_a_large_side_is_left_to_the_planner(spark):
    lines = spark.range(100).withColumnRenamed("id", "k")
    few, many = small_side(spark.range(5).toDF("k"), "t-few", rows=5), small_side(spark.range(6).toDF("k"), "t-many", rows=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [lines.join(side, "k")._jdf.queryExecution().sparkPlan().toString() for side in (few, many)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]


def test_lines_are_not_shuffled_for_the_names_of_parts(spark, tmp_path, monkeypatch):
    tables = {
        "part": ("p_partkey long, p_name string", [(k, f"part {k}") for k in range(1, 9)] + [(3, "third again"), (None, "no key")]),
        "nation": ("n_nationkey int, n_name string", [(1, "FRANCE")]), "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 1)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(k, 1 + k % 2, dt.datetime(1998, 1, k)) for k in range(1, 6)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(1 + k % 5, None if k == 9 else k % 10, 1, 1 + k // 5, 2.0, 3.0, 0.0, 0.0, "N", "O", dt.datetime(1998, 2, 1)) for k in range(20)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        views = []
        for limit in (retail_view.PART_ROWS, 9):  # 10 parts
            monkeypatch.setattr(retail_view, "PART_ROWS", limit)
            views.append(retail_transactions(spark, str(tmp_path)))
        plans = [v._jdf.queryExecution().sparkPlan().toString() for v in views]
        few, many = [sorted(map(str, v.collect())) for v in views]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ["BroadcastHashJoin [l_partkey" in p for p in plans] == [True, False], plans
    assert few == many and len(few) == 16 + 2
