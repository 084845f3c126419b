"""Exact quantiles by narrowing brackets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions import quantile_value


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.995, 0.9999, 1.0])
def test_equals_numpy(spark, seed, q):
    rng = np.random.default_rng(seed)
    x = {1: rng.normal(size=5000), 2: rng.integers(0, 5, 5000).astype(float), 3: np.r_[np.zeros(4000), rng.lognormal(size=1001)]}[seed]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(5)
    for rows in (20_000, 300, 10):
        assert quantile_value(df, "x", q, bracket_rows=rows, accuracy=200) == pytest.approx(np.quantile(x, q), rel=1e-12, abs=1e-12)


def test_small_and_empty(spark):
    df = spark.range(1).select(F.lit(7).alias("x"))
    assert quantile_value(df, "x", 0.5) == 7.0
    assert quantile_value(df.limit(0), "x", 0.5) is None


def test_sketches_of_parts_merge_and_leave_one_pass(spark):
    from shelfcast.functions import merged_sketch, quantile_sketches
    rng = np.random.default_rng(8)
    x = np.r_[rng.lognormal(size=30_000), rng.integers(0, 3, 9_000)]
    df = spark.createDataFrame([(float(v), i % 3) for i, v in enumerate(x)], "x double, part int").repartition(4).persist()
    df.count()
    old = quantile_sketches(df.where("part < 2"), "x", "part").persist()
    both = old.union(quantile_sketches(df.where("part = 2"), "x", "part"))  # a landed part's sketch is added
    assert both.count() == 3
    sketch = merged_sketch(both)
    for q in (0.1, 0.5, 0.995, 0.9999):
        spark.sparkContext.setJobGroup(f"quantile-{q}", "one pass")
        assert quantile_value(df, "x", q, sketch=sketch) == pytest.approx(np.quantile(x, q), rel=1e-12)
        # adaptive execution runs the map side and the result of one query as two jobs
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantile-{q}")) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_misleading_sketch_changes_nothing(spark):
    x = np.arange(5000.0)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    other = df.select((F.col("x") * 100 + 10_000).alias("x")).agg(F.kll_sketch_agg_double("x", 200)).first()[0]
    for q in (0.0, 0.3, 0.995):
        assert quantile_value(df, "x", q, sketch=other) == pytest.approx(np.quantile(x, q))
    assert quantile_value(df.limit(0), "x", 0.5, sketch=other) is None
