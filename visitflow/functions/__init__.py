"""Column expressions: histogram buckets and time conversions."""

from visitflow.functions.buckets import (
    DURATION_EDGES_S, DURATION_LABELS, OTHER_LABEL, PAGE_EDGES, PAGE_LABELS, PAGE_TOP,
    SESSION_COUNT_LABEL, duration_bucket, page_bucket,
)
from visitflow.functions.predicates import all_not_null
from visitflow.functions.timecols import (
    as_wall_time, epoch_ms_to_ts, hour_of, minute_of, seconds_between, timestamp_literal,
    ts_to_epoch_ms,
)

__all__ = [
    "DURATION_EDGES_S", "DURATION_LABELS", "OTHER_LABEL", "PAGE_EDGES", "PAGE_LABELS", "PAGE_TOP",
    "SESSION_COUNT_LABEL", "all_not_null", "as_wall_time", "duration_bucket", "epoch_ms_to_ts", "hour_of",
    "minute_of", "page_bucket", "seconds_between", "timestamp_literal", "ts_to_epoch_ms",
]
