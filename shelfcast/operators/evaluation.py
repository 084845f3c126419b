"""Validation tables on a scored frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import quantile_value


def time_split(df: DataFrame, horizon: str, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """M2: train = date before ``horizon``, validation = on or after it."""
    h = F.lit(horizon).cast("date")
    return df.where(F.col(date_col) < h), df.where(F.col(date_col) >= h)


def split_summary(df: DataFrame, horizon: str, date_col: str = "date") -> DataFrame:
    """Rows and quantity per side of the split."""
    side = F.when(F.col(date_col) < F.lit(horizon).cast("date"), "train").otherwise("validation")
    return df.groupBy(side.alias("split")).agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.sum("qty").cast("bigint").alias("sum_qty"))


def validation_results(scored: DataFrame, target: str = "qty", prediction: str = "predictions",
                       date_col: str = "date") -> DataFrame:
    """M9: target, prediction, absolute error, month, squared error."""
    err = F.abs(F.col(target) - F.col(prediction))
    return scored.select(F.col(target), F.col(prediction).alias("prediction"), err.alias("error"),
                         F.month(date_col).alias("month"), F.pow(err, 2).alias("squared_error"))


def median_abs_error(results: DataFrame) -> DataFrame:
    """M10, exact: model errors are nearly all distinct, so no task merges them (see ``quantile_value``)."""
    value = F.lit(quantile_value(results, "error", 0.5)).cast("double")
    return results.sparkSession.range(1).select(value.alias("median_abs_error"))


def monthly_rmse(results: DataFrame) -> DataFrame:
    """Sqrt of the mean squared error per month number."""
    return results.groupBy("month").agg(F.sqrt(F.avg("squared_error")).alias("rmse"))


def error_histogram(results: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width histogram of absolute errors over [0, max error]."""
    top = results.agg(F.max("error").alias("m")).scalar()
    raw = F.when(top > 0, F.floor(F.col("error") / top * bins)).otherwise(F.lit(0))
    bucket = F.least(raw, F.lit(bins - 1)).cast("int")
    return (results.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
            .select("bucket", (F.col("bucket") * top / bins).alias("lower"),
                    ((F.col("bucket") + 1) * top / bins).alias("upper"), "n"))


def r2_score(scored: DataFrame, target: str = "qty", prediction: str = "predictions") -> DataFrame:
    """M7: coefficient of determination, 1 - SS_res / SS_tot, as a one-row table."""
    agg = scored.agg(F.sum(F.pow(F.col(target) - F.col(prediction), 2)).alias("ss_res"),
                     (F.var_pop(target) * F.count(F.lit(1))).alias("ss_tot"))
    return agg.select((1 - F.try_divide(F.col("ss_res"), F.col("ss_tot"))).alias("r2"))


def patience_rule(curve: DataFrame, patience: int = 40, step: str = "iter", error: str = "error") -> DataFrame:
    """M5 as a table: for every step of an error curve, its best so far and whether training still runs.

    (step, error, best_error, best_step, since_best, running): training runs up to and
    with the first step that is ``patience`` steps past the best; the kept model is
    the ``best_step`` of the last running row.  A curve has one row per boosting
    iteration, so its window is bounded by the iteration budget.
    """
    before = Window.orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = curve.select(step, error).withColumn("best_error", F.min(error).over(before))
    fresh = F.when(F.col(error) == F.col("best_error"), F.col(step))
    lag = F.lag("best_error").over(Window.orderBy(step))
    d = d.withColumn("_new", F.when(lag.isNull() | (F.col(error) < lag), fresh))
    d = d.withColumn("best_step", F.max("_new").over(before)).withColumn("since_best", F.col(step) - F.col("best_step"))
    stopped = F.max((F.col("since_best") >= patience).cast("int")).over(Window.orderBy(step).rowsBetween(Window.unboundedPreceding, -1))
    return d.withColumn("running", F.coalesce(stopped, F.lit(0)) == 0).drop("_new")
