import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import accuracy as A
from shelfcast.operators import evaluation as EV

SCORED = "stock_code string, date date, qty double, predictions double"
D = dt.date(2011, 1, 3)


def test_bias_rmse_message(spark):
    df = spark.createDataFrame([("85123A", D, 10.0, 9.0), ("85123A", D, 10.0, 9.0)], SCORED)
    r = A.item_accuracy(df).first()
    assert r.bias == pytest.approx(-0.10) and r.rmse == pytest.approx(1.0) and r.n_rows == 2
    assert r.message == "Model is underestimating the demand for 85123A"
    txt = A.item_accuracy(df).select(A.bias_text()).first()[0]
    assert txt == "-10.00%"


def test_zero_bias_is_over_and_zero_actuals_null(spark):
    df = spark.createDataFrame([("A", D, 2.0, 2.0), ("B", D, 0.0, 3.0)], SCORED)
    rows = {r.item: r for r in A.item_accuracy(df).collect()}
    assert rows["A"].message == "Model is overestimating the demand for item A"
    assert rows["B"].bias is None


def test_item_lookup_unknown(spark):
    df = spark.createDataFrame([("A", D, 2.0, 2.0)], SCORED)
    acc = A.item_accuracy(df)
    assert A.item_lookup(acc, "A").count() == 1
    with pytest.raises(KeyError):
        A.item_lookup(acc, "nope")


def test_validation_tables(spark):
    df = spark.createDataFrame([("A", dt.date(2011, 1, 3), 3.0, 1.0), ("A", dt.date(2011, 2, 3), 5.0, 5.0),
                                ("A", dt.date(2011, 2, 4), 1.0, 2.0)], SCORED)
    res = EV.validation_results(df)
    assert EV.median_abs_error(res).first()[0] == pytest.approx(1.0)
    m = {r.month: r.rmse for r in EV.monthly_rmse(res).collect()}
    assert m[1] == pytest.approx(2.0) and m[2] == pytest.approx((0.5) ** 0.5)
    h = {r.bucket: r.n for r in EV.error_histogram(res, bins=4).collect()}
    assert h == {0: 1, 2: 1, 3: 1}
    r2 = EV.r2_score(df).first().r2
    y = [3.0, 5.0, 1.0]
    p = [1.0, 5.0, 2.0]
    ybar = sum(y) / 3
    assert r2 == pytest.approx(1 - sum((a - b) ** 2 for a, b in zip(y, p)) / sum((a - ybar) ** 2 for a in y))


def test_time_split(spark):
    df = spark.createDataFrame([("A", dt.date(2010, 12, 31), 1.0, 1.0), ("A", dt.date(2011, 1, 1), 1.0, 1.0)], SCORED)
    tr, va = EV.time_split(df, "2011-01-01")
    assert (tr.count(), va.count()) == (1, 1)


def test_lookup_reads_only_row_groups_that_can_hold_the_item(spark):
    from shelfcast.session import scratch_dir
    acc = spark.range(40_000).select(F.format_string("item%06d", (F.col("id") * 7919) % 40_000).alias("item"), F.lit(0.1).alias("bias"),
                                     F.lit(1.0).alias("rmse"), F.lit(3).cast("long").alias("n_rows"), F.lit("m").alias("message"))
    path = scratch_dir(spark, "accuracy-bloom")
    A.write_item_accuracy(acc.repartition(20), path)
    table = spark.read.parquet(path)

    def rows_read(code):
        found = table.where(F.col("item") == code)
        n = len(found.collect())
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return n, leaf.metrics().apply("numOutputRows").value()

    n, read = rows_read("item012345")
    assert n == 1 and read <= 3 * 2000  # of 20 files with a row group of about 2,000 rows each, spanning all codes
    assert rows_read("item012345x")[1] <= 2 * 2000
    assert A.item_lookup(table, "item012345").first().item == "item012345"
    with pytest.raises(KeyError):
        A.item_lookup(table, "item012345x")
