"""A hot key holding a third of the rows: results stay whole and the plan
pre-aggregates before shuffling (no window buffering the hot group)."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import cleaning as C
from shelfcast.operators import matching as M
from test_netting_brute_force import brute_force_netting

TS = dt.datetime(2010, 12, 1, 8, 26)


def skewed(spark, n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:      # the hot key: anonymous buyers of one item, qty 1, some returns
            inv = f"C{i:06d}" if i % 9 == 0 else f"{i:06d}"
            rows.append((inv, "85123A", "white hanging heart", -1 if inv.startswith("C") else 1,
                         TS, 2.55, None, "UK", i))
        else:
            rows.append((f"{i:06d}", f"{i % 97:05d}", "jumbo bag red", 1 + i % 5, TS, 1.0,
                         str(i % 13), "UK", i))
    from conftest import LINE_SCHEMA
    return spark.createDataFrame(rows, LINE_SCHEMA)


def test_hot_key_netting_whole_and_exact(spark):
    d = C.flag_cancelled(skewed(spark))
    got = {r.row_order for r in M.net_cancellations(d).select("row_order").collect()}
    pdf = d.select("stock_code", "customer_id", "qty", "is_cancelled", "row_order").toPandas()
    assert got == brute_force_netting(pdf)


def test_hot_key_plan_is_partial_aggregate(spark):
    d = C.flag_cancelled(skewed(spark))
    plan = M.net_cancellations(d)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_hot_key_dedup_and_modes(spark):
    d = skewed(spark)
    copies = d.unionByName(d.withColumn("row_order", F.col("row_order") + 100000))
    assert C.deduplicate(copies).count() == d.count()
    modes = {r.stock_code: r.canonical for r in C.description_modes(
        copies.withColumn("description", F.when(F.col("row_order") % 2 == 0, "a long text one")
                          .otherwise(F.col("description")))).collect()}
    assert "85123A" in modes
