"""Row rules of the cleaning stage.

Each rule sees the output of the rule before; ``plans.clean_transactions``
chains them in the original order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import exact_quantile, mode_from_counts, starts_with_any, strip_ws
from shelfcast.session import small_side

# Raw -> working column names.
RAW_TO_WORKING = {
    "Invoice": "invoice_id",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "qty",
    "InvoiceDate": "invoice_timestamp",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
# The late rename and the final column order of clean lines.
LATE_RENAME = {"unit_price": "price", "invoice_date": "date"}
CLEAN_COLUMNS = ("invoice_id", "stock_code", "description", "qty", "price", "customer_id",
                 "country", "date")
# Description prefixes of multipacks, and the shortest kept length.
MULTIPACK_PREFIXES = ("set of", "pack of")
MIN_DESCRIPTION_LEN = 7
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def rename_columns(df: DataFrame) -> DataFrame:
    """C1 (first half): raw names -> working names; already-renamed input passes."""
    present = {k: v for k, v in RAW_TO_WORKING.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def parse_dates(df: DataFrame) -> DataFrame:
    """Text timestamps parsed with a fixed format (ANSI: bad text raises);
    ``invoice_date`` is the midnight date."""
    ts = F.col("invoice_timestamp")
    if dict(df.dtypes)["invoice_timestamp"] == "string":
        ts = F.to_timestamp(ts, TIMESTAMP_FORMAT)
    return df.withColumn("invoice_timestamp", ts).withColumn("invoice_date", F.to_date(ts))


def normalize_text(df: DataFrame) -> DataFrame:
    """Lower-case and strip (any Unicode whitespace) the description."""
    return df.withColumn("description", strip_ws(F.lower("description")))


def deduplicate(df: DataFrame, order_col: str | None = "row_order") -> DataFrame:
    """C4: drop exact duplicates (nulls equal), keeping the first in file order.

    One aggregation over all data columns; partial aggregation collapses
    copies map-side, so a group of copies holding a third of the rows sends
    one row per task through the shuffle.
    """
    if order_col is None:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c != order_col]
    return df.groupBy(*keys).agg(F.min(order_col).alias(order_col)).select(*df.columns)


def flag_cancelled(df: DataFrame) -> DataFrame:
    """cancelled = invoice starts with 'C'; a null invoice counts as cancelled."""
    return df.withColumn("is_cancelled",
                         F.coalesce(F.startswith(F.col("invoice_id"), F.lit("C")), F.lit(True)))


def drop_adjustments(df: DataFrame) -> DataFrame:
    """Drop lines whose invoice id is a 7-character non-cancelled id.

    The original collects such ids and anti-joins; both facts depend on the
    id alone, so the anti-join folds into a row filter (no shuffle).
    """
    keep = F.col("is_cancelled") | F.coalesce(F.length("invoice_id") != 7, F.lit(True))
    return df.where(keep)


def drop_cancelled(df: DataFrame) -> DataFrame:
    """Keep non-cancelled lines and drop the flag."""
    return df.where(~F.col("is_cancelled")).drop("is_cancelled")


def upper_code(df: DataFrame) -> DataFrame:
    """C11: upper-case the stock code."""
    return df.withColumn("stock_code", F.upper("stock_code"))


def _description_counts(df: DataFrame) -> DataFrame:
    # (code, description) -> lines, pre-aggregated map-side.
    return df.groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("n"))


def inconsistent_descriptions(df: DataFrame) -> DataFrame:
    """Codes with more than one distinct (non-null) description."""
    return (_description_counts(df).groupBy("stock_code")
            .agg(F.count("description").alias("n_descriptions"))
            .where(F.col("n_descriptions") > 1))


def description_modes(df: DataFrame) -> DataFrame:
    """For codes of C12: the most frequent description (ties -> smallest)."""
    return (_description_counts(df).groupBy("stock_code")
            .agg(F.count("description").alias("n_descriptions"),
                 mode_from_counts(F.col("description"), F.col("n")).alias("canonical"))
            .where(F.col("n_descriptions") > 1)
            .select("stock_code", "canonical"))


def canonical_description(df: DataFrame, cut: str | None = None) -> DataFrame:
    """Replace each inconsistent code's description (null ones included)
    by the code's mode.  The mode table has one row per code; AQE broadcasts
    it when small at runtime, else it is a shuffle join with skew splitting.
    With ``cut`` it is written first and the lines aren't shuffled for a small one."""
    modes = small_side(description_modes(df), "description-modes", cut)
    out = df.join(modes, "stock_code", "left")
    return (out.withColumn("description", F.coalesce(F.col("canonical"), F.col("description")))
            .select(*df.columns))


def valid_description(df: DataFrame) -> DataFrame:
    """C14: drop null descriptions and those of at most 7 characters."""
    return df.where(F.col("description").isNotNull()
                    & (F.length("description") > MIN_DESCRIPTION_LEN))


def positive_qty(df: DataFrame) -> DataFrame:
    """C15."""
    return df.where(F.col("qty") > 0)


def drop_multipacks(df: DataFrame) -> DataFrame:
    """Drop descriptions starting with 'set of' or 'pack of'."""
    return df.where(~starts_with_any(F.col("description"), MULTIPACK_PREFIXES))


def trim_upper_quantile(df: DataFrame, col: str, q: float, approx: bool = False) -> DataFrame:
    """Keep rows strictly below the ``q`` quantile of ``col`` over ``df``.

    The exact quantile is computed at once, by two passes over ``df`` while the plan is built, and
    stands in it as a literal; with ``approx`` it is a scalar subquery.  Strict ``<`` removes the whole
    top value when the quantile equals the maximum.
    """
    return df.where(F.col(col) < exact_quantile(df, col, q, approx=approx))


def trim_qty(df: DataFrame, q: float = 0.995, approx: bool = False) -> DataFrame:
    """C17."""
    return trim_upper_quantile(df, "qty", q, approx)


def positive_price(df: DataFrame) -> DataFrame:
    """C18."""
    return df.where(F.col("unit_price") > 0)


def trim_price(df: DataFrame, q: float = 0.9999, approx: bool = False) -> DataFrame:
    """C19."""
    return trim_upper_quantile(df, "unit_price", q, approx)


def finalize_columns(df: DataFrame, order_col: str | None = "row_order") -> DataFrame:
    """C1 (second half): unit_price -> price, invoice_date -> date, drop the timestamp."""
    out = df.withColumnsRenamed(LATE_RENAME).drop("invoice_timestamp")
    cols = list(CLEAN_COLUMNS) + ([order_col] if order_col and order_col in out.columns else [])
    return out.select(*cols)
