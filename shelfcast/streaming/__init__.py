"""Structured Streaming ingest for the item-accuracy table."""

from shelfcast.streaming.accuracy_stream import (ingest_scored, item_accuracy_stream, run_item_accuracy,
                                                 scored_stream)

__all__ = ["ingest_scored", "item_accuracy_stream", "run_item_accuracy", "scored_stream"]
