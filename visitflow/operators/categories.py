"""Category operators: click/order/pay counts, top categories, their sessions and detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.schemas import DETAIL_COLUMNS


def category_counts(visits: DataFrame, pay_requires_action: bool = False) -> DataFrame:
    """``(category_id, click_count, order_count, pay_count)`` for categories with all three > 0.

    A click counts ``click_category_id`` of rows with action ``click``, an order
    ``order_category_id`` of rows with action ``order`` (category 0 included in both), a payment
    any row with ``pay_category_id != 0`` whatever its action (``pay_requires_action=True`` also
    asks for action ``pay``).  One scan: every row is expanded to its (category, kind) pairs, then
    one partially aggregated ``groupBy``."""
    action = F.col("action")
    pay_ok = F.col("pay_category_id") != 0
    if pay_requires_action:
        pay_ok = pay_ok & (action == "pay")
    pairs = F.array(
        F.struct(F.when(action == "click", F.col("click_category_id")).alias("category_id"), F.lit("click").alias("kind")),
        F.struct(F.when(action == "order", F.col("order_category_id")).alias("category_id"), F.lit("order").alias("kind")),
        F.struct(F.when(pay_ok, F.col("pay_category_id")).alias("category_id"), F.lit("pay").alias("kind")),
    )
    kind = F.col("kind")
    return (
        visits.select(F.inline(pairs))
        .where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(
            F.count_if(kind == "click").alias("click_count"),
            F.count_if(kind == "order").alias("order_count"),
            F.count_if(kind == "pay").alias("pay_count"),
        )
        .where((F.col("click_count") > 0) & (F.col("order_count") > 0) & (F.col("pay_count") > 0))
    )


def top_categories(counts: DataFrame, n: int = 10, task_id: int = 1) -> DataFrame:
    """The ``n`` categories with most clicks, then orders, then payments, then lowest id
    (a distributed top-k: ``TakeOrderedAndProject``)."""
    return (
        counts.orderBy(
            F.col("click_count").desc(), F.col("order_count").desc(), F.col("pay_count").desc(), F.col("category_id")
        )
        .limit(n)
        .select(F.lit(task_id).alias("task_id"), "category_id", "click_count", "order_count", "pay_count")
    )


def _top_clicks(visits: DataFrame, top: DataFrame) -> DataFrame:
    """Click rows (``click_category_id != 0``, any action) of the top categories; AQE
    measures ``top`` and broadcasts it when it is small."""
    clicks = visits.where(F.col("click_category_id") != 0).select(
        F.col("click_category_id").alias("category_id"), "session_id"
    )
    return clicks.join(top.select("category_id", "click_count"), "category_id")


def category_click_events(visits: DataFrame, top: DataFrame, task_id: int = 1) -> DataFrame:
    """One row per click on a top category, carrying the category's total click count
    (``task_id, category_id, session_id, click_count``)."""
    return _top_clicks(visits, top).select(
        F.lit(task_id).alias("task_id"), "category_id", "session_id", "click_count"
    )


def top_sessions_per_category(
    visits: DataFrame, top: DataFrame, n_sessions: int = 10, task_id: int = 1
) -> DataFrame:
    """For each top category, the ``n_sessions`` sessions with most clicks on it (ties by
    session id).  The literal rank bound lets Spark trim each map task's rows per category
    before the shuffle."""
    per_session = (
        _top_clicks(visits, top)
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    order = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id"))
    return (
        per_session.withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= int(n_sessions))
        .select(F.lit(task_id).alias("task_id"), "category_id", "session_id", "click_count")
    )


def session_detail(visits: DataFrame, selected: DataFrame, task_id: int = 1) -> DataFrame:
    """All visits of the sessions in ``selected`` (a frame with ``session_id``), as the 12
    detail columns.  A semi join: a session listed many times still yields its rows once.
    ``selected`` repeats a session once per click; the ids are de-duplicated first (partially,
    before their shuffle), and that shuffle already partitions them by session for the join."""
    sessions = selected.select("session_id").where(F.col("session_id").isNotNull()).distinct()
    rows = visits.join(sessions, "session_id", "left_semi")
    return rows.select(
        F.lit(task_id).alias("task_id"),
        "user_id",
        "session_id",
        "page_id",
        "action_time",
        "search_keyword",
        "click_category_id",
        "click_product_id",
        F.col("order_category_id").alias("order_category_ids"),
        F.col("order_product_id").alias("order_product_ids"),
        F.col("pay_category_id").alias("pay_category_ids"),
        F.col("pay_product_id").alias("pay_product_ids"),
    ).select(*DETAIL_COLUMNS)
