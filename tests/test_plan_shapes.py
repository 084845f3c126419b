"""Regression guard for plan shapes that matter at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators import accuracy as A
from shelfcast.operators import clustering as K
from shelfcast.operators import modeling as MD
from shelfcast.plans import catalog
from shelfcast.plans.demand import demand_table
from shelfcast.session import materialize

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def daily(spark, clean_small):
    return materialize(demand_table(clean_small, "day"), "t-shapes")


def test_cleaning_segments(spark):
    import shelfcast.plans.cleaning as PC
    captured = []
    orig = PC.materialize

    def capture(df, name, how="parquet"):
        captured.append(df)
        return orig(df, name, how)

    PC.materialize = capture
    try:
        final = catalog.clean(spark, SF_SMALL)
    finally:
        PC.materialize = orig
    for df in captured + [final]:
        plan = executed(df)
        assert not any(op in plan for op in FORBIDDEN), plan
        assert "Window" not in plan   # netting and modes are aggregates, not windows


def test_demand_and_downstream(spark, clean_small, daily):
    frames = [demand_table(clean_small, "day"),
              A.item_accuracy(A.naive_forecast(daily, "2000-01-01")),
              K.series_vectors(daily),
              MD.ordered_target_statistics(daily, "stock_code")]
    for df in frames:
        plan = executed(df)
        assert not any(op in plan for op in FORBIDDEN), plan


def test_demand_reads_only_needed_columns(spark, clean_small):
    clean = materialize(clean_small, "t-clean-parquet")
    plan = executed(demand_table(clean, "day"))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    assert schemas and all("customer_id" not in s and "country" not in s for s in schemas)


def test_demand_sums_lines_before_joining(spark, clean_small):
    """With broadcasts off the lines themselves never enter a join."""
    lines = materialize(clean_small, "t-lines-parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = demand_table(lines, "day")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # every scan of the lines is under an aggregate, and that under the joins
    depth = {}
    for line in plan.splitlines():
        name = line.lstrip(" :+-")
        level = len(line) - len(name)
        depth = {k: v for k, v in depth.items() if k < level}
        if name.startswith("Relation"):
            above = [depth[k] for k in sorted(depth, reverse=True)]
            first = next(a for a in above if a in ("Aggregate", "Join"))
            assert first == "Aggregate", plan
        depth[level] = "Aggregate" if name.startswith("Aggregate") else "Join" if name.startswith("Join") else ""


def test_rules_before_netting_write_nothing(spark):
    import shelfcast.plans.cleaning as PC
    calls = []
    orig, PC.materialize = PC.materialize, lambda df, name, how="parquet": calls.append(name) or df
    try:
        for rule in ("parse_dates", "deduplicate", "drop_adjustments", "net_cancellations"):
            catalog.stage(spark, SF_SMALL, rule)
    finally:
        PC.materialize = orig
    assert calls == []


def test_quantile_trims_merge_no_distinct_values_in_one_task(spark, clean_small):
    from shelfcast.operators import cleaning as C
    from shelfcast.operators import evaluation as EV
    frames = [C.trim_qty(clean_small), EV.median_abs_error(clean_small.select(F.col("price").alias("error")))]
    for df in frames:
        assert "percentile(" not in executed(df) and "median(" not in executed(df)


def test_tables_landed_by_stock_need_no_shuffle(spark, clean_small, daily):
    from shelfcast.operators import features as FT
    from shelfcast.sources import land_by_stock
    lines = land_by_stock(clean_small.withColumns({"year": F.year("date"), "month": F.month("date")}), "t_lines_by_stock", 4)
    demand = land_by_stock(daily, "t_demand_by_stock", 4)
    try:
        frames = {"price_stats": FT.price_stats(lines, catalog.ORDER), "monthly": FT.monthly_invoices_by_stock(lines), "lags": FT.add_qty_lags(demand),
                  "matrix": K.series_matrix(demand), "encoding": MD.ordered_target_statistics(demand, "stock_code", prior=1.0)}
        for name, df in frames.items():
            plan = executed(df)
            assert "Exchange" not in plan, (name, plan)
        assert FT.add_qty_lags(demand).exceptAll(FT.add_qty_lags(daily)).count() == 0
    finally:
        for t in ("t_lines_by_stock", "t_demand_by_stock"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
