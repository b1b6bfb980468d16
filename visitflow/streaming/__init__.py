"""Structured Streaming jobs."""

from visitflow.streaming.ad_stream import (
    AdStream, blacklist_table_name, current_blacklist, ensure_blacklist_table, read_ad_tables,
    start_ad_stream,
)
from visitflow.streaming.audit import audit_counts, counted_state, state_batches
from visitflow.streaming.heavy import heavy_clickers

__all__ = [
    "AdStream", "audit_counts", "blacklist_table_name", "counted_state", "current_blacklist", "ensure_blacklist_table",
    "heavy_clickers", "read_ad_tables", "start_ad_stream", "state_batches",
]
