import datetime as dt
import os

from pyspark.sql import functions as F

from shelfcast.operators import accuracy as A
from shelfcast.session import scratch_dir
from shelfcast.sources import read_scored, read_transactions, union_parts, write_table


def test_read_transactions_keeps_blanks_and_order(spark):
    path = scratch_dir(spark, "t-raw")
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(local)
    with open(os.path.join(local, "data.csv"), "w", encoding="ISO-8859-1") as f:
        f.write("Invoice\tStockCode\tDescription\tQuantity\tInvoiceDate\tPrice\tCustomer ID\tCountry\n")
        f.write("489434\t85048\t  15CM CHRISTMAS GLASS BALL \t12\t2009-12-01 07:45:00\t6.95\t13085\tUnited Kingdom\n")
        f.write("C489449\t22087\tPAPER BUNTING CAFÉ\t-12\t2009-12-01 10:33:00\t2.95\t\tGermany\n")
    df = read_transactions(spark, path).collect()
    assert df[0]["Description"] == "  15CM CHRISTMAS GLASS BALL " and df[0]["Quantity"] == 12
    assert df[1]["Customer ID"] is None and df[1]["Description"].endswith("CAFÉ")
    assert df[0]["row_order"] < df[1]["row_order"]


def test_union_parts_fills_missing(spark):
    p1, p2 = scratch_dir(spark, "t-p1"), scratch_dir(spark, "t-p2")
    write_table(spark.createDataFrame([("1", "a")], "Invoice string, Country string"), p1, sep=",")
    write_table(spark.createDataFrame([("2",)], "Invoice string"), p2, sep=",")
    rows = sorted(union_parts(spark, [p1, p2], sep=",").drop("row_order").collect())
    assert [tuple(r) for r in rows] == [("1", "a"), ("2", None)]


def test_union_parts_save(spark):
    p1, p2, out = scratch_dir(spark, "t-s1"), scratch_dir(spark, "t-s2"), scratch_dir(spark, "t-sout")
    write_table(spark.createDataFrame([("1", " a ")], "Invoice string, Country string"), p1, sep=",")
    write_table(spark.createDataFrame([("2",)], "Invoice string"), p2, sep=",")
    saved = union_parts(spark, [p1, p2], sep=",", order_col=None, save_to=out)
    assert sorted((r.Invoice, r.Country) for r in saved.collect()) == [("1", " a "), ("2", None)]


def test_stream_equals_batch_and_resumes(spark):
    from shelfcast.streaming import run_item_accuracy
    src, ledger = scratch_dir(spark, "t-stream"), scratch_dir(spark, "t-ledger")
    ckpt = scratch_dir(spark, "t-ckpt")
    rows = [("A", "2011-01-03", 10.0, 9.0), ("A", "2011-01-04", 10.0, 9.0), ("B", "2011-01-03", 4.0, 6.0)]
    df = spark.createDataFrame(rows, "stock_code string, date string, qty double, predictions double")
    write_table(df, src, sep=";")
    acc = run_item_accuracy(spark, src, ledger, checkpoint_location=ckpt)
    got = {r.item: (round(r.bias, 9), round(r.rmse, 9), r.n_rows) for r in acc.collect()}
    batch = A.item_accuracy(read_scored(spark, src))
    want = {r.item: (round(r.bias, 9), round(r.rmse, 9), r.n_rows) for r in batch.collect()}
    assert got == want
    # New files arrive in the same folder: only they are ingested on restart.
    write_table(df, src, sep=";", mode="append")
    again = run_item_accuracy(spark, src, ledger, checkpoint_location=ckpt)
    assert {r.item: r.n_rows for r in again.collect()} == {"A": 4, "B": 2}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
