"""``prepare_demand``: clean lines -> model table at day or week level."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.operators import features as FT
from shelfcast.session import materialize


def _demand_rows(clean: DataFrame, level: str, order_col: str, keep_null_lags: bool) -> DataFrame:
    """Demand aggregate, features, peak season."""
    return FT.add_peak_season(FT.demand_rows(clean, level, keep_null_lags, order_col))


def demand_table(clean: DataFrame, level: str = "day", order_col: str = "row_order",
                 keep_null_lags: bool = False, lag_order: str = "chronological") -> DataFrame:
    """F1-F12 without the clustering columns: the S-oracle part of the model table."""
    return FT.add_qty_lags(_demand_rows(clean, level, order_col, keep_null_lags), lag_order)


def prepare_demand(clean: DataFrame, level: str = "day", order_col: str = "row_order",
                   keep_null_lags: bool = False, lag_order: str = "chronological",
                   with_clusters: bool = True, max_item_clusters: int = 10,
                   max_series_clusters: int = 3, seed: int = 42) -> DataFrame:
    """The full model table: features, demand, peak season, product_type,
    time_series_type and quantity lags (the original's column order)."""
    d = _demand_rows(clean, level, order_col, keep_null_lags)
    if with_clusters:
        from shelfcast.operators import clustering as K
        # The demand table feeds both segmentations, their join-backs and the
        # lag window: write it once.
        d = materialize(d, f"demand-{level}")
        d = K.item_cluster(d, max_clusters=max_item_clusters, seed=seed)
        d = K.series_cluster(d, max_cluster=max_series_clusters, seed=seed)
    return FT.add_qty_lags(d, lag_order)
