"""Options that the registered queries do not exercise."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators import cleaning as C
from shelfcast.plans.catalog import raw_lines
from shelfcast.plans.cleaning import clean_transactions
from shelfcast.session import scratch_dir
from shelfcast.sources import union_parts, write_table


def test_approx_quantile_trims_close_to_exact(spark):
    exact = clean_transactions(raw_lines(spark, SF_SMALL)).count()
    approx = clean_transactions(raw_lines(spark, SF_SMALL), approx=True).count()
    assert abs(exact - approx) <= exact * 0.01


def test_approx_quantile_on_integers(spark):
    df = spark.range(1000).select(F.col("id").cast("int").alias("qty"))
    # percentile_approx returns an observed value (994 here), so 0..993 stay.
    assert C.trim_qty(df, approx=True).count() == 994


def test_partitioned_write_prunes_partitions(spark, clean_small):
    path = scratch_dir(spark, "t-part")
    d = clean_small.drop("row_order").withColumns({"year": F.year("date"), "month": F.month("date")})
    write_table(d, path, fmt="parquet", partition_by=["year", "month"])
    back = spark.read.parquet(path).where((F.col("year") == 1996) & (F.col("month") == 3))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert back.count() == d.where((F.col("year") == 1996) & (F.col("month") == 3)).count()


def test_union_parts_parquet(spark):
    p1, p2 = scratch_dir(spark, "t-pq1"), scratch_dir(spark, "t-pq2")
    spark.createDataFrame([(1, "a")], "Quantity int, Country string").write.parquet(p1)
    spark.createDataFrame([(2, 3.5)], "Quantity int, Price double").write.parquet(p2)
    rows = union_parts(spark, [p1, p2], fmt="parquet").orderBy("row_order").drop("row_order").collect()
    assert [r.asDict() for r in rows] == [{"Quantity": "1", "Country": "a", "Price": None},
                                          {"Quantity": "2", "Country": None, "Price": "3.5"}]


def test_landed_long_order_gives_same_clean_lines(spark):
    from shelfcast.sources import land_transactions
    a = clean_transactions(raw_lines(spark, SF_SMALL))
    landed = land_transactions(raw_lines(spark, SF_SMALL))
    assert dict(landed.dtypes)["row_order"] == "bigint"
    b = clean_transactions(landed)
    cols = [c for c in a.columns if c != "row_order"]
    assert a.count() == b.count()
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    dedup = C.deduplicate(C.rename_columns(landed))
    dedup.write.format("noop").mode("overwrite").save()
    plan = dedup._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
