"""Feature engineering and the day/week demand table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import date_parts, peak_season, week_start

# Lines that do not identify a demand row, and the lag offsets.
NON_KEY_COLUMNS = ("customer_id", "country", "invoice_id", "qty")
QTY_LAGS = (1, 5, 7, 30)
DAY_ONLY = ("day", "day_of_week", "day_of_year")
LEVELS = ("day", "week")


def check_level(level: str) -> None:
    if level not in LEVELS:
        raise ValueError(f"unknown demand level {level!r}: expected one of {', '.join(LEVELS)}")


def reorder_columns(df: DataFrame) -> DataFrame:
    """quantity first."""
    return df.select("qty", *[c for c in df.columns if c != "qty"])


def add_date_parts(df: DataFrame) -> DataFrame:
    """day, day_of_week (Mon=0), day_of_year, ISO week, month, year."""
    return df.withColumns(date_parts(F.col("date")))


def price_stats(df: DataFrame, order_col: str = "row_order") -> DataFrame:
    """F3 (table): per stock, mode (ties -> smallest), median and last price.

    One group-by: mode and median keep a value->count map per group and merge
    partial maps, ``max_by`` keeps one pair, so a hot stock is combined
    map-side.  "Last" is last in file order (``order_col``).
    """
    return df.groupBy("stock_code").agg(
        F.mode("price", True).alias("price_mode"),
        F.median("price").alias("price_median"),
        F.max_by("price", order_col).alias("price_last"))


def add_price_stats(df: DataFrame, order_col: str = "row_order") -> DataFrame:
    """broadcast the per-stock price statistics back to the lines."""
    return df.join(price_stats(df, order_col), "stock_code", "left").select(
        *df.columns, "price_mode", "price_median", "price_last")


def add_description_len(df: DataFrame) -> DataFrame:
    """F4."""
    return df.withColumn("description_len", F.length("description"))


def monthly_invoices(df: DataFrame) -> DataFrame:
    """Distinct invoices per (year, month)."""
    return df.groupBy("year", "month").agg(F.count_distinct("invoice_id").alias("n_invoice"))


def monthly_invoices_by_stock(df: DataFrame) -> DataFrame:
    """Distinct invoices per (stock, year, month)."""
    return (df.groupBy("stock_code", "year", "month")
            .agg(F.count_distinct("invoice_id").alias("n_invoice")))


def invoice_lag_month(df: DataFrame) -> DataFrame:
    """previous month-row's invoice count (rows, not calendar months).

    The un-partitioned window sees one row per calendar month, so its single
    task is bounded by the calendar, not by the data.
    """
    w = Window.orderBy("year", "month")
    return monthly_invoices(df).select(
        "year", "month", F.lag("n_invoice", 1).over(w).alias("n_invoice_lag1m"))


def invoice_lag_month_stock(df: DataFrame) -> DataFrame:
    """the same per stock; gap-blind like the original."""
    w = Window.partitionBy("stock_code").orderBy("year", "month")
    return monthly_invoices_by_stock(df).select(
        "stock_code", "year", "month", F.lag("n_invoice", 1).over(w).alias("n_invoice_lag1m_stock"))


def add_invoice_lags(df: DataFrame) -> DataFrame:
    """Left-join both lag tables.  The monthly table is bounded by
    the calendar (one row per month), so broadcasting it is safe; the
    per-stock table grows with the catalogue and is left to AQE."""
    out = df.join(F.broadcast(invoice_lag_month(df)), ["year", "month"], "left")
    out = out.join(invoice_lag_month_stock(df), ["stock_code", "year", "month"], "left")
    return out.select(*df.columns, "n_invoice_lag1m", "n_invoice_lag1m_stock")


def feature_lines(df: DataFrame, order_col: str = "row_order") -> DataFrame:
    """F1-F7 on clean lines: one row per line with every feature attached."""
    d = reorder_columns(df)
    d = add_date_parts(d)
    d = add_price_stats(d, order_col)
    d = add_description_len(d)
    return add_invoice_lags(d)


def demand_keys(columns: list[str], order_col: str | None = "row_order") -> list[str]:
    return [c for c in columns if c not in NON_KEY_COLUMNS and c != order_col]


def aggregate_demand(lines: DataFrame, level: str = "day", keep_null_lags: bool = False,
                     order_col: str | None = "row_order") -> DataFrame:
    """Sum quantity over every other feature column.

    ``level='week'`` moves the date to its Monday and drops the day columns;
    month, year and the monthly lags stay keys, so a week crossing a month
    end gives two rows.  Rows with a null key are dropped (pandas group-by
    semantics): each stock's first month and the first calendar month go,
    unless ``keep_null_lags``.
    """
    check_level(level)
    d = lines
    if level == "week":
        d = d.withColumn("date", week_start(F.col("date"))).drop(*DAY_ONLY)
    keys = demand_keys(d.columns, order_col)
    if not keep_null_lags:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        d = d.where(cond)
    return d.groupBy(*keys).agg(F.sum("qty").alias("qty"))


def demand_rows(clean: DataFrame, level: str = "day", keep_null_lags: bool = False,
                order_col: str | None = "row_order") -> DataFrame:
    """The rows of ``aggregate_demand(feature_lines(clean))``, summed before anything is joined.

    Every feature depends on the stock, the month or the description, so quantities
    are first summed per (stock, description, price, date or week, year, month), a
    partial aggregate and the lines' one shuffle for this branch; the small price and
    invoice tables are then joined to the demand rows.  Year and month are those of
    the line's own date, also where the week starts in the month before.
    """
    check_level(level)
    d = clean.select("stock_code", "description", "price", "qty", "date", F.year("date").alias("year"), F.month("date").alias("month"))
    if level == "week":
        d = d.withColumn("date", week_start(F.col("date")))
    keys = ["stock_code", "description", "price", "date", "year", "month"]
    summed = d.groupBy(*keys).agg(F.sum("qty").alias("qty"))
    parts = date_parts(F.col("date"))
    summed = summed.withColumns({k: v for k, v in parts.items() if k not in ("year", "month") and (level == "day" or k not in DAY_ONLY)})
    dated = add_date_parts(clean)
    out = add_description_len(summed.join(price_stats(clean, order_col), "stock_code", "left"))
    out = out.join(F.broadcast(invoice_lag_month(dated)), ["year", "month"], "left")
    out = out.join(invoice_lag_month_stock(dated), ["stock_code", "year", "month"], "left")
    day = [c for c in parts if c not in ("year", "month") and (level == "day" or c not in DAY_ONLY)]
    columns = ["stock_code", "description", "price", "date", *day, "month", "year", "price_mode", "price_median", "price_last",
               "description_len", "n_invoice_lag1m", "n_invoice_lag1m_stock"]
    if not keep_null_lags:
        out = out.dropna(subset=columns)
    return out.select(*columns, "qty")


def add_peak_season(df: DataFrame) -> DataFrame:
    """F10."""
    return df.withColumn("peak_season", peak_season(F.col("month")))


def lag_order(df: DataFrame, order: str = "chronological") -> list:
    """Row order of the quantity lags inside each stock.

    ``chronological`` (default): date, then year and month (a split week has
    two rows on one Monday), then description and price.
    ``group_key``: the order the original code really uses, the sorted group
    keys after the stock (description, price, date, ... month before year).
    """
    if order == "chronological":
        return ["date", "year", "month", "description", "price"]
    if order == "group_key":
        return [c for c in demand_keys(df.columns) if c not in ("stock_code", "qty", "peak_season",
                                                                 "product_type", "time_series_type")]
    raise ValueError(f"unknown lag order {order!r}")


def add_qty_lags(df: DataFrame, order: str = "chronological", lags=QTY_LAGS) -> DataFrame:
    """quantity shifted by 1, 5, 7, 30 rows per stock.

    Partitioned by stock: a task sorts one stock's demand rows, one for each date,
    price and description that it sold at, however many lines these stand for.
    """
    w = Window.partitionBy("stock_code").orderBy(*lag_order(df, order))
    return df.withColumns({f"qty_lag{n}d": F.lag("qty", n).over(w) for n in lags})
