"""Session operators: range filter, per-session summary, histogram, proportional sample."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.functions.buckets import (
    DURATION_EDGES_S, DURATION_LABELS, OTHER_LABEL, PAGE_EDGES, PAGE_LABELS, PAGE_TOP,
    SESSION_COUNT_LABEL, duration_bucket, page_bucket,
)
from visitflow.functions.timecols import hour_of, seconds_between, timestamp_literal


def visits_in_range(
    visits: DataFrame,
    users: DataFrame,
    start: str | dt.datetime,
    end: str | dt.datetime,
) -> DataFrame:
    """Visits with ``start <= action_time < end`` whose user exists in ``users``.

    A semi join: a visit is kept once even if ``users`` repeats its id.  The time predicate is a
    column-vs-literal comparison, so it reaches the parquet scan."""
    ts_type = visits.schema["action_time"].dataType
    in_range = visits.where(
        (F.col("action_time") >= timestamp_literal(start, ts_type))
        & (F.col("action_time") < timestamp_literal(end, ts_type))
    )
    known = users.select(F.col("user_id").alias("_known_user")).where(F.col("_known_user").isNotNull())
    # an expression join (not a using-column join) keeps the left columns in their order
    return in_range.join(known, F.col("user_id") == F.col("_known_user"), "left_semi")


def session_summary(visits: DataFrame) -> DataFrame:
    """Per session: first and last action time and the number of distinct pages; sessions that
    saw exactly one distinct page are dropped.  Partial aggregation happens before the shuffle,
    so a session with a huge share of the rows costs one row per (task, page)."""
    return (
        visits.where(F.col("session_id").isNotNull() & F.col("action_time").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count_distinct("page_id").alias("page_count"),
        )
        .where(F.col("page_count") != 1)
    )


def _histogram_wide(
    summary: DataFrame,
    duration_edges=DURATION_EDGES_S,
    duration_labels=DURATION_LABELS,
    page_edges=PAGE_EDGES,
    page_top=PAGE_TOP,
    page_labels=PAGE_LABELS,
) -> tuple[DataFrame, list[str]]:
    """One global aggregate (one row) with a count per label; one pass over the summary."""
    dur = duration_bucket(seconds_between(F.col("start_time"), F.col("end_time")), duration_edges, duration_labels)
    pages = page_bucket(F.col("page_count"), page_edges, page_top, page_labels)
    labels = [*duration_labels, *page_labels, OTHER_LABEL]
    bucketed = summary.select(dur.alias("dur"), pages.alias("pages"))
    counts = [F.count_if(F.col("dur") == label).alias(f"c{i}") for i, label in enumerate(duration_labels)]
    counts += [
        F.count_if(F.col("pages") == label).alias(f"c{len(duration_labels) + i}")
        for i, label in enumerate([*page_labels, OTHER_LABEL])
    ]
    counts.append(F.count(F.lit(1)).alias("total"))
    return bucketed.agg(*counts), labels


def session_histogram(summary: DataFrame, **edges) -> DataFrame:
    """``(bucket, session_count)``: every duration and page-count label (zeros included), the
    ``other`` page bucket only when non-empty, and ``sessionCount``.  Empty input gives zeros."""
    wide, labels = _histogram_wide(summary, **edges)
    rows = [F.struct(F.lit(label).alias("bucket"), F.col(f"c{i}").alias("session_count")) for i, label in enumerate(labels)]
    rows.append(F.struct(F.lit(SESSION_COUNT_LABEL).alias("bucket"), F.col("total").alias("session_count")))
    return (
        wide.select(F.inline(F.array(*rows)))
        .where((F.col("bucket") != OTHER_LABEL) | (F.col("session_count") > 0))
    )


def histogram_metrics() -> dict[str, Column]:
    """The histogram's counts as aggregates over a summary, to be observed while it is written."""
    dur = duration_bucket(seconds_between(F.col("start_time"), F.col("end_time")))
    pages = page_bucket(F.col("page_count"))
    return {**{label: F.count_if(dur == label) for label in DURATION_LABELS},
            **{label: F.count_if(pages == label) for label in (*PAGE_LABELS, OTHER_LABEL)},
            SESSION_COUNT_LABEL: F.count(F.lit(1))}


def histogram_rows(counted: dict[str, int]) -> list[tuple[str, int]]:
    """The rows of ``session_histogram`` from observed ``histogram_metrics``."""
    labels = [*DURATION_LABELS, *PAGE_LABELS, OTHER_LABEL, SESSION_COUNT_LABEL]
    return [(label, int(counted[label])) for label in labels if label != OTHER_LABEL or counted[label]]


def session_histogram_share(summary: DataFrame, **edges) -> DataFrame:
    """``(bucket, session_count, share)`` with ``share = session_count / sessionCount`` (null
    when there are no sessions); ``other`` only when non-empty."""
    wide, labels = _histogram_wide(summary, **edges)
    total = F.col("total").cast("double")
    rows = [
        F.struct(
            F.lit(label).alias("bucket"),
            F.col(f"c{i}").alias("session_count"),
            F.try_divide(F.col(f"c{i}").cast("double"), total).alias("share"),
        )
        for i, label in enumerate(labels)
    ]
    return (
        wide.select(F.inline(F.array(*rows)))
        .where((F.col("bucket") != OTHER_LABEL) | (F.col("session_count") > 0))
    )


def sample_sessions(
    summary: DataFrame, n: int = 30, seed: int = 42, task_id: int = 1
) -> DataFrame:
    """Sample about ``n`` sessions, spread over start hours in proportion to their size.

    Each hour gets ``least(hour_n, ceil(n * hour_n / total))`` sessions (integer arithmetic), the
    first ones in the seeded order ``md5(seed:session_id), session_id``.  Since every quota is at
    most ``n``, the per-hour ranking keeps ``row_number <= n`` with a literal bound, which Spark
    applies in each map task before the shuffle (WindowGroupLimit): a hot hour costs at most
    ``n`` rows per task.  The per-hour quotas are one row per hour."""
    keyed = summary.select(
        "session_id",
        "start_time",
        "end_time",
        hour_of(F.col("start_time")).alias("hour"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.col("session_id"))).alias("sample_key"),
    )
    # count(end_time) equals count(*) here (end_time is never null); it keeps end_time in this
    # branch, so both branches read the same summary aggregate and Spark reuses its exchange
    # instead of computing the summary twice.
    per_hour = keyed.groupBy("hour").agg(F.count("end_time").alias("hour_n"))
    # The total over a frame of one row per hour: a small, bounded single-partition window.
    quotas = per_hour.withColumn("total", F.sum("hour_n").over(Window.partitionBy())).select(
        "hour",
        F.least(F.col("hour_n"), F.expr(f"({int(n)} * hour_n + total - 1) div total")).alias("quota"),
    )
    order = Window.partitionBy("hour").orderBy("sample_key", "session_id")
    ranked = keyed.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= int(n))
    return ranked.join(quotas, "hour").where(F.col("rn") <= F.col("quota")).select(
        F.lit(task_id).alias("task_id"), "session_id", "start_time", "end_time"
    )
