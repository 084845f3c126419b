"""Print the physical-plan facts of the main stages (after running them, so
AQE's final plans are shown): operator counts, scans with their pruned
schema and pushed filters, and join strategies.

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import collections
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import shelfcast.plans.cleaning as PC  # noqa: E402
from shelfcast.operators import accuracy as A  # noqa: E402
from shelfcast.operators import clustering as K  # noqa: E402
from shelfcast.operators import modeling as MD  # noqa: E402
from shelfcast.plans import catalog  # noqa: E402
from shelfcast.plans.demand import demand_table  # noqa: E402
from shelfcast.session import build_session, materialize  # noqa: E402

OPS = ("Scan", "Exchange", "BroadcastExchange", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
       "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "Window", "Sort", "ReusedExchange", "Generate", "Expand")


def facts(name: str, df) -> None:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = collections.Counter()
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-*|]*([A-Za-z]+)", line)
        if m and m.group(1) in OPS:
            counts[m.group(1)] += 1
    print(f"### {name}")
    print("operators:", dict(sorted(counts.items())))
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (struct<.*>)", line)
        table = re.search(r"Location: \w+ \[[^\]]*?([\w.-]+)\]", line)
        print("  scan", table.group(1) if table else "?", "| pushed:", pushed.group(1)[:140] if pushed else "-",
              "| read:", schema.group(1)[:160] if schema else "-")
    print()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    captured = []
    orig = PC.materialize

    def capture(df, name, how="parquet"):
        captured.append((name, df))
        return orig(df, name, how)

    PC.materialize = capture
    clean = catalog.clean(spark, sf)
    PC.materialize = orig
    for name, df in captured:
        facts(f"cleaning segment written as {name}", df)
    facts("cleaning final segment (quantile trims)", clean)
    clean_m = materialize(clean, "plans-clean")
    daily = demand_table(clean_m, "day")
    facts("demand_daily from clean lines", daily)
    daily_m = materialize(daily, "plans-daily")
    facts("item_accuracy on the naive forecast", A.item_accuracy(A.naive_forecast(daily_m, "2000-01-01")))
    facts("series vectors (K7/K8 input)", K.series_vectors(daily_m))
    facts("ordered target statistics (M15)", MD.ordered_target_statistics(daily_m, "stock_code"))


if __name__ == "__main__":
    main()
