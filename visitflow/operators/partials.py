"""Session summaries from daily parts that are kept: a range of days merges its parts instead of reading its visits.

A part holds, for a session on a day, the first and last action and the exact set of its pages as bitmaps of
32,768 pages each (Spark's bitmap functions), cut behind the last page.  Minima, maxima and bitmaps of parts
merge to those of their union in any order, so parts of days, and of pieces of a day, are interchangeable."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.functions.timecols import timestamp_literal

DAY = "action_date"


def session_parts(visits: DataFrame) -> DataFrame:
    """(action_date, session_id, page_range, start_time, end_time, pages): the parts of each session by day; ``page_range``
    is null where a part saw no page."""
    known = visits.where(F.col("session_id").isNotNull() & F.col("action_time").isNotNull())
    bit = F.bitmap_bit_position("page_id")
    parts = known.groupBy(F.to_date("action_time").alias(DAY), "session_id", F.bitmap_bucket_number("page_id").alias("page_range")).agg(
        F.min("action_time").alias("start_time"), F.max("action_time").alias("end_time"),
        F.bitmap_construct_agg(bit).alias("pages"), F.max(bit).alias("last_bit"))
    return parts.withColumn("pages", F.expr("substring(pages, 1, cast(last_bit div 8 + 1 as int))")).drop("last_bit")


def write_session_parts(visits: DataFrame, path: str) -> None:
    """The parts of the days of ``visits`` into a table by day; days that are there already are replaced."""
    session_parts(visits).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def merged_summary(parts: DataFrame) -> DataFrame:
    """``session_summary`` of the visits that ``parts`` were made of."""
    by_range = parts.groupBy("session_id", "page_range").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.bitmap_or_agg("pages").alias("pages"))
    return by_range.groupBy("session_id").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.sum(F.when(F.col("page_range").isNotNull(), F.bitmap_count("pages")).otherwise(0)).alias("page_count")).where(F.col("page_count") != 1)


def summary_of_range(spark: SparkSession, path: str, visits: DataFrame, start: str, end: str) -> DataFrame:
    """``session_summary`` of ``start <= action_time < end``: whole days from the table of parts at ``path``, the pieces of
    the first and last day from ``visits``, whose time predicate reaches their scan."""
    first, last = (dt.datetime.fromisoformat(t) for t in (start, end))
    day_from = first if first == first.replace(hour=0, minute=0, second=0, microsecond=0) else first + dt.timedelta(days=1)
    day_from, day_to = day_from.date(), last.date()
    kind = visits.schema["action_time"].dataType
    at = F.col("action_time")
    inside = (at >= timestamp_literal(start, kind)) & (at < timestamp_literal(end, kind))
    if day_from >= day_to:  # no whole day
        return merged_summary(session_parts(visits.where(inside)))
    low, high = (timestamp_literal(f"{d} 00:00:00", kind) for d in (day_from, day_to))
    edges = visits.where(inside & ((at < low) | (at >= high)))
    days = spark.read.parquet(path).where((F.col(DAY) >= F.lit(day_from)) & (F.col(DAY) < F.lit(day_to)))
    return merged_summary(days.unionByName(session_parts(edges).select(*days.columns)))
