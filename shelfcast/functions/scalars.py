"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware leading/trailing whitespace: Spark's trim removes spaces only,
# while Python's str.strip removes any whitespace (tabs, newlines, ...).
_EDGE_WS = r"(?U)^\s+|\s+$"


def strip_ws(c: Column) -> Column:
    """Python-style ``str.strip()``."""
    return F.regexp_replace(c, _EDGE_WS, "")


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    """``str.startswith(tuple)``; null in, null out."""
    out = None
    for p in prefixes:
        t = F.startswith(c, F.lit(p))
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def date_parts(date: Column) -> dict[str, Column]:
    """Calendar features of a date: day, Monday=0 weekday, day of year,
    ISO week (with the calendar year, as pandas' ``isocalendar().week``),
    month, year."""
    return {
        "day": F.dayofmonth(date),
        "day_of_week": F.weekday(date),
        "day_of_year": F.dayofyear(date),
        "week": F.weekofyear(date),
        "month": F.month(date),
        "year": F.year(date),
    }


def week_start(date: Column) -> Column:
    """Monday of the ISO week containing ``date``, as a date."""
    return F.to_date(F.date_trunc("week", date))


# The peak-season months (September to November).
PEAK_MONTHS = (9, 10, 11)


def peak_season(month: Column) -> Column:
    return month.isin(*PEAK_MONTHS).cast("int")


def bias_message(bias: Column, item: Column) -> Column:
    """Under/over-estimating sentence by the sign of the bias; zero counts as over."""
    # The two message texts.
    under = F.concat(F.lit("Model is underestimating the demand for "), item)
    over = F.concat(F.lit("Model is overestimating the demand for item "), item)
    return F.when(bias < 0, under).otherwise(over)
