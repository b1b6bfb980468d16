"""The library's expressions as SQL functions, and the session analysis as SQL text.

The functions are temporary SQL functions: Spark puts their bodies in place of the calls before it optimises, so a
query that uses them has the plan of the DataFrame form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitflow.functions.buckets import DURATION_EDGES_S, DURATION_LABELS, OTHER_LABEL, PAGE_EDGES, PAGE_LABELS, PAGE_TOP


def _cases(column: str, edges, labels, tail: str) -> str:
    whens = " ".join(f"WHEN {column} < {edge} THEN '{label}'" for edge, label in zip(edges, labels))
    return f"CASE {whens} {tail} END"


def function_bodies() -> dict[str, str]:
    """The functions' signatures and bodies by name."""
    return {
        "duration_bucket": "(seconds BIGINT) RETURNS STRING RETURN " + _cases(
            "seconds", DURATION_EDGES_S, DURATION_LABELS, f"WHEN seconds IS NOT NULL THEN '{DURATION_LABELS[-1]}'"),
        "page_bucket": "(pages BIGINT) RETURNS STRING RETURN " + _cases(
            "pages", PAGE_EDGES, PAGE_LABELS, f"WHEN pages <= {PAGE_TOP} THEN '{PAGE_LABELS[-1]}' WHEN pages IS NOT NULL THEN '{OTHER_LABEL}'"),
        "seconds_between": "(start TIMESTAMP_NTZ, finish TIMESTAMP_NTZ) RETURNS BIGINT RETURN timestampdiff(SECOND, start, finish)",
        "hour_bucket": "(at TIMESTAMP_NTZ) RETURNS TIMESTAMP RETURN date_trunc('hour', at)",
        "click_day": "(epoch_ms BIGINT) RETURNS DATE RETURN to_date(timestamp_millis(epoch_ms))",
    }


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; returns their names."""
    for name, body in function_bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(function_bodies())


#: The visits of a time range whose user exists; :start and :end are texts of wall-clock times.
VISITS_IN_RANGE = """
    SELECT v.* FROM {visits} v LEFT SEMI JOIN {users} u ON v.user_id = u.user_id
    WHERE v.action_time >= CAST(:start AS TIMESTAMP_NTZ) AND v.action_time < CAST(:end AS TIMESTAMP_NTZ)"""
SESSION_SUMMARY = """
    SELECT session_id, min(action_time) AS start_time, max(action_time) AS end_time, count(DISTINCT page_id) AS page_count
    FROM {visits} WHERE session_id IS NOT NULL AND action_time IS NOT NULL
    GROUP BY session_id HAVING count(DISTINCT page_id) <> 1"""
SESSION_BUCKETS = """
    SELECT duration_bucket(seconds_between(start_time, end_time)) AS duration, page_bucket(page_count) AS pages, count(*) AS session_count
    FROM {summary} GROUP BY ALL"""


def visits_in_range_sql(spark: SparkSession, start, end, visits: DataFrame, users: DataFrame) -> DataFrame:
    """``operators.visits_in_range`` as parameterised SQL; the texts of ``start`` and ``end`` are parameters, never part
    of the statement."""
    return spark.sql(VISITS_IN_RANGE, args={"start": str(start), "end": str(end)}, visits=visits, users=users)


def session_summary_sql(spark: SparkSession, visits: DataFrame) -> DataFrame:
    return spark.sql(SESSION_SUMMARY, visits=visits)


def session_buckets_sql(spark: SparkSession, summary: DataFrame) -> DataFrame:
    """Sessions by duration and page bucket together, which the two one-way histograms do not tell."""
    register_functions(spark)
    return spark.sql(SESSION_BUCKETS, summary=summary)

