"""Forecast accuracy per item.

The original serves one item per HTTP request from a file loaded in memory;
here one group-by produces the table for every item and a lookup is a filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import bias_message


def naive_forecast(demand: DataFrame, horizon: str, order: list[str] | None = None) -> DataFrame:
    """A deterministic stand-in forecast: each row predicts the previous
    row's quantity of the same stock (chronological).  Returns the scored
    layout (stock_code, date, qty, predictions) for rows on/after ``horizon``.
    """
    order = order or ["date", "year", "month", "description", "price"]
    w = Window.partitionBy("stock_code").orderBy(*order)
    prev = F.lag("qty", 1).over(w).cast("double")
    return (demand.select("stock_code", "date", F.col("qty").cast("double").alias("qty"),
                          prev.alias("predictions"))
            .where((F.col("date") >= F.lit(horizon).cast("date")) & F.col("predictions").isNotNull()))


def item_bias(scored: DataFrame) -> DataFrame:
    """A1: sum(predictions) / sum(qty) - 1 per stock; null when the actuals sum to 0."""
    return scored.groupBy("stock_code").agg(
        (F.try_divide(F.sum("predictions"), F.sum("qty")) - 1).alias("bias"))


def item_rmse(scored: DataFrame) -> DataFrame:
    """A2: root mean squared error per stock (null inputs skipped)."""
    return scored.groupBy("stock_code").agg(
        F.sqrt(F.avg(F.pow(F.col("predictions") - F.col("qty"), 2))).alias("rmse"))


def item_accuracy(scored: DataFrame) -> DataFrame:
    """A0: item, bias, rmse, row count and message for every item in one pass."""
    agg = scored.groupBy("stock_code").agg(
        F.sum("predictions").alias("_p"), F.sum("qty").alias("_q"),
        F.avg(F.pow(F.col("predictions") - F.col("qty"), 2)).alias("_mse"),
        F.count(F.lit(1)).alias("n_rows"))
    bias = F.try_divide(F.col("_p"), F.col("_q")) - 1
    return agg.select(
        F.col("stock_code").alias("item"), bias.alias("bias"), F.sqrt("_mse").alias("rmse"),
        "n_rows", bias_message(bias, F.col("stock_code")).alias("message"))


def bias_text(bias_col: str = "bias"):
    """The bias as percent text with two decimals, e.g. ``-10.00%``.

    Java formatting rounds exact ties half-up (0.125 -> 0.13); Python rounds
    the binary value (0.12).  Compare the numeric bias, not this text.
    """
    return F.format_string("%.2f%%", F.col(bias_col) * 100)


def write_item_accuracy(accuracy: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The accuracy table as Parquet for point lookups: a Bloom filter on ``item`` in every row group, and rows
    sorted by item within the files, so that a lookup reads only the row groups that can hold its code."""
    n = max(1, accuracy.count())
    (accuracy.sortWithinPartitions("item").write.mode(mode).option("parquet.bloom.filter.enabled#item", "true")
     .option("parquet.bloom.filter.expected.ndv#item", str(min(n, 10_000_000))).parquet(path))


def item_lookup(accuracy: DataFrame, stock_code) -> DataFrame:
    """A4: one item's row, with the bias as percent text; ``KeyError`` when the code is unknown.

    ``stock_code`` may be a literal or a Column (e.g. a scalar subquery).  Read from a table of
    :func:`write_item_accuracy`, a literal code skips the row groups that can't hold it.  The row is
    fetched once and returned as a table.
    """
    code = stock_code if not isinstance(stock_code, str) else F.lit(stock_code)
    found = accuracy.where(F.col("item") == code).withColumn("bias_text", bias_text())
    rows = found.collect()  # an item has one row
    if not rows:
        raise KeyError(f"no accuracy row for item {stock_code}")
    return accuracy.sparkSession.createDataFrame(rows, found.schema)
