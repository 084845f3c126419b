"""Benchmark: the headline stages of the pipeline at one scale factor.

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Stages run as a user would chain them: clean once, build the demand tables
from the clean lines, then accuracy, segmentation and the model.  Every
stage is forced with the ``noop`` sink (full computation, no collect).

Before timing, the same stages run once, untimed, on the smallest scale
factor (``BENCH_WARMUP_DIR``, default sf0.001) so JIT and code generation
warm-up is not charged to the first timed stage; set it to "" to skip.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shelfcast.operators import accuracy as A  # noqa: E402
from shelfcast.operators import clustering as K  # noqa: E402
from shelfcast.operators import modeling as MD  # noqa: E402
from shelfcast.plans.catalog import raw_lines  # noqa: E402
from shelfcast.plans.cleaning import clean_transactions  # noqa: E402
from shelfcast.plans.demand import demand_table  # noqa: E402
from shelfcast.session import build_session, materialize  # noqa: E402


def force(df):
    df.write.format("noop").mode("overwrite").save()


def run_stages(spark, sf_dir: str, times: dict) -> None:
    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def stage_clean():
        c = clean_transactions(raw_lines(spark, sf_dir))
        return materialize(c, "bench-clean")

    clean = timed("clean_transactions", stage_clean)

    def stage_daily():
        return materialize(demand_table(clean, "day"), "bench-daily")

    daily = timed("demand_daily", stage_daily)
    timed("demand_weekly", lambda: force(demand_table(clean, "week")))
    timed("item_accuracy", lambda: force(A.item_accuracy(A.naive_forecast(daily, "2000-01-01"))))
    timed("item_cluster", lambda: force(K.item_clusters(daily, max_clusters=10)))
    timed("series_cluster", lambda: force(K.series_clusters(daily, max_cluster=3)))

    def stage_model():
        m = MD.DemandModel("bench", {"loss": "RMSE", "seed": 42, "iterations": 60, "max_depth": 6,
                                     "learning_rate": 0.2})
        m.set_data(daily, "2000-01-01").learn(grow=os.environ.get("BENCH_GROW", "budget"))
        force(m.get_val_results())

    timed("fit_demand_model", stage_model)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="shelfcast-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        run_stages(spark, warm, {})
    times: dict[str, float] = {}
    run_stages(spark, sf_dir, times)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "pipeline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
