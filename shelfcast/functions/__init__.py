"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side)."""

from shelfcast.functions.scalars import (bias_message, date_parts, peak_season, starts_with_any,
                                         strip_ws, week_start)
from shelfcast.functions.aggregates import exact_quantile, merged_sketch, mode_from_counts, quantile_sketches, quantile_value

__all__ = ["bias_message", "date_parts", "peak_season", "starts_with_any", "strip_ws",
           "week_start", "exact_quantile", "mode_from_counts", "quantile_value",
           "quantile_sketches", "merged_sketch"]
