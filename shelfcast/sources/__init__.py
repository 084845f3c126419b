"""Readers and writers and the retail view over the driver tables."""

from shelfcast.sources.files import (RAW_SCHEMA, SCORED_SCHEMA, land_by_stock, land_transactions, read_scored,
                                     read_transactions, union_parts, write_table)
from shelfcast.sources.retail_view import load_tables, retail_transactions, retail_view_sql

__all__ = [
    "RAW_SCHEMA", "SCORED_SCHEMA", "land_by_stock", "land_transactions", "read_transactions", "read_scored", "union_parts",
    "write_table", "load_tables", "retail_transactions", "retail_view_sql",
]
