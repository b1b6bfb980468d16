"""Date and time expressions (the session time zone is UTC, see ``config.SESSION_CONF``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("SECOND", start, end)


def hour_of(ts: Column) -> Column:
    """The hour bucket of a timestamp (24-hour clock)."""
    return F.date_trunc("hour", ts)


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_to_epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds, floored (a TIMESTAMP_NTZ is read as UTC wall time)."""
    return F.unix_millis(ts.cast(T.TimestampType()))


def as_wall_time(ts: Column) -> Column:
    """An instant as UTC wall-clock time (TIMESTAMP_NTZ), the type result tables use."""
    return ts.cast(T.TimestampNTZType())


def timestamp_literal(value: str | dt.datetime, data_type: T.DataType) -> Column:
    """A literal of the same timestamp type as the column it is compared with, so that the
    comparison stays a plain column-vs-literal predicate the parquet scan can push down."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(data_type, T.TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(value))
    return F.to_timestamp(F.lit(value)).cast(data_type)
