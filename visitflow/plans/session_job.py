"""The batch session analysis: one range filter feeding six result tables.

Plan shape:

* the visits of the range are persisted (memory and disk) and shared by the summary, the
  category counts, the click rows and the detail rows; a lost executor only recomputes its
  blocks from the scan;
* the per-session summary feeds the sample; it is an aggregate that costs two shuffles, so it is
  checkpointed to the shared checkpoint folder rather than recomputed.  The pass that writes the
  checkpoint also counts the histogram's buckets, so the histogram has no job of its own;
* every table's row count comes with its write;
* the top categories (at most ``top_n`` rows) are checkpointed once for the three frames
  that use them, so the category aggregate runs once.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from visitflow.config import checkpoint_root
from visitflow.operators.categories import (
    category_click_events, category_counts, session_detail, top_categories, top_sessions_per_category,
)
from visitflow.operators.sessions import (
    histogram_metrics, histogram_rows, sample_sessions, session_summary, visits_in_range,
)
from visitflow.plans.counts import TableCounts
from visitflow.sinks.parquet import read_task, replace_task

# Result table names (the reference's, plus the histogram table it only printed and the ranked
# sessions its comments promised).
TABLES = (
    "session_step", "session_random_extract", "top10_category", "top10_category_session",
    "top10_category_session_ranked", "session_detail",
)


def session_job(
    spark: SparkSession,
    visits: DataFrame,
    users: DataFrame,
    start: str,
    end: str,
    out_dir: str | None = None,
    task_id: int = 1,
    sample_size: int = 30,
    seed: int = 42,
    top_n: int = 10,
    sessions_per_category: int = 10,
    pay_requires_action: bool = False,
    write_table: Callable[[str, DataFrame], None] | None = None,
    parallel_writes: int = 3,
    counts: TableCounts | None = None,
) -> dict[str, DataFrame]:
    """Run the session analysis for ``[start, end)``.  With ``out_dir`` every table is written
    there (partitioned by ``task_id``; a rerun of a task replaces its rows, also by none) and the returned
    frames read the written tables; without it the frames are returned unwritten (the summary
    and the top categories are still checkpointed; the range filter is left uncached).

    ``counts`` gets the number of sessions and, where tables are written, of the rows of each.

    ``write_table(name, frame)`` replaces the parquet writer, e.g. by the tables of the same names in a
    database: ``Database(...).task_writer(task_id)``; the frames are then
    returned unwritten-to-parquet, as computed.  The six tables are independent once the summary
    and the top categories are checkpointed, so up to ``parallel_writes`` of them are submitted
    at once (Spark runs jobs from several threads; small writes then overlap the large ones)."""
    checkpoint_root(spark)
    writing = out_dir is not None or write_table is not None
    in_range = visits_in_range(visits, users, start, end)
    if writing:
        in_range = in_range.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = TableCounts() if counts is None else counts
        summary = counts.watch("sessions", session_summary(in_range), **histogram_metrics()).checkpoint(eager=True)
        steps = [(task_id, *row) for row in histogram_rows(counts.get("sessions"))]
        top = top_categories(category_counts(in_range, pay_requires_action), top_n, task_id).checkpoint(eager=True)
        events = category_click_events(in_range, top, task_id)
        outputs = {
            "session_step": spark.createDataFrame(steps, "task_id int, bucket string, session_count long"),
            "session_random_extract": sample_sessions(summary, sample_size, seed, task_id),
            "top10_category": top,
            "top10_category_session": events,
            "top10_category_session_ranked": top_sessions_per_category(
                in_range, top, sessions_per_category, task_id),
            "session_detail": session_detail(in_range, events, task_id),
        }
        if not writing:
            return outputs
        def write(name: str) -> None:
            watched = counts.watch(name, outputs[name])
            if write_table is not None:
                write_table(name, watched)
            else:
                replace_task(watched, f"{out_dir}/{name}", task_id)

        with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
            for done in [pool.submit(write, name) for name in outputs]:
                done.result()  # re-raises the first failure
    finally:
        if writing:
            in_range.unpersist()
    if write_table is not None:
        return outputs
    return {name: read_task(spark, f"{out_dir}/{name}", outputs[name].schema, task_id) for name in TABLES}
