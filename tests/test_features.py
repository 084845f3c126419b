import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features as FT
from shelfcast.plans.demand import demand_table

CLEAN = ("invoice_id string, stock_code string, description string, qty int, price double, "
         "customer_id string, country string, date date, row_order bigint")


def test_iso_week_with_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2011, 1, 1),)], "date date")
    r = FT.add_date_parts(df).first()
    assert (r.week, r.year, r.day_of_week) == (52, 2011, 5)
    from shelfcast.functions import week_start
    assert df.select(week_start(F.col("date")).alias("w")).first().w == dt.date(2010, 12, 27)


def _lines(spark, rows):
    return spark.createDataFrame(rows, CLEAN)


def test_invoice_lag_is_row_shift_not_calendar(spark):
    rows = [("1", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 1, 5), 0),
            ("2", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 1, 6), 1),
            ("3", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 3, 5), 2)]
    lags = FT.invoice_lag_month_stock(FT.add_date_parts(_lines(spark, rows))).orderBy("month").collect()
    assert [(r.month, r.n_invoice_lag1m_stock) for r in lags] == [(1, None), (3, 2)]


def test_first_month_rows_vanish(spark):
    rows = [("1", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 1, 5), 0),
            ("2", "S", "jumbo bag red", 2, 1.0, "c", "UK", dt.date(2010, 2, 5), 1)]
    d = demand_table(_lines(spark, rows), "day")
    assert [r.date for r in d.collect()] == [dt.date(2010, 2, 5)]
    keep = demand_table(_lines(spark, rows), "day", keep_null_lags=True)
    assert keep.count() == 2


def test_week_split_across_month_end(spark):
    rows = [("1", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 11, 2), 0),
            ("2", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 12, 1), 1),
            ("3", "S", "jumbo bag red", 2, 1.0, "c", "UK", dt.date(2010, 11, 30), 2),
            ("4", "S", "jumbo bag red", 3, 1.0, "c", "UK", dt.date(2010, 10, 1), 3)]
    w = demand_table(_lines(spark, rows), "week").where(F.col("date") == dt.date(2010, 11, 29))
    assert sorted((r.month, r.qty) for r in w.collect()) == [(11, 2), (12, 1)]


def test_price_stats_mode_median_last(spark):
    rows = [("1", "S", "jumbo bag red", 1, p, "c", "UK", dt.date(2010, 1, 5), i)
            for i, p in enumerate([3.0, 1.0, 1.0, 3.0, 2.0])]
    r = FT.price_stats(_lines(spark, rows)).first()
    assert (r.price_mode, r.price_median, r.price_last) == (1.0, 2.0, 2.0)


def test_level_check(spark):
    rows = [("1", "S", "jumbo bag red", 1, 1.0, "c", "UK", dt.date(2010, 1, 5), 0)]
    with pytest.raises(ValueError):
        demand_table(_lines(spark, rows), "month")


def test_peak_season(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    got = [r.peak_season for r in FT.add_peak_season(df).orderBy("month").collect()]
    assert got == [0] * 8 + [1, 1, 1, 0]
