"""Audit of the stream's tables against the state that its queries have checkpointed.

A table row is written by ``foreachBatch`` or a sink, the count it came from lies in the state store.  After a
crash, a restore of one of the two or a deleted file they may differ; Spark's state data source reads the state
without the query, so the difference is a join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.schemas import TABLE_KEYS
from visitflow.sinks.parquet import read_upserted

#: Queries whose state is the running count of a table.
COUNTED = {"daily": "ad_daily_count", "region": "ad_stat", "user": "ad_user_click_count"}


def counted_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The running counts of one query: its keys and ``click_count`` as of its last whole batch."""
    state = spark.read.format("statestore").load(checkpoint)
    keys = [F.col(f"key.{f.name}").alias(f.name) for f in state.schema["key"].dataType.fields if f.name != "day"]
    (count,) = state.schema["value"].dataType.names
    return state.select(*keys, F.col(f"value.{count}").alias("click_count"))


def state_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(operator, store, partitions, first_batch, last_batch)`` of the state of one query."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorName").alias("operator"), F.col("stateStoreName").alias("store"), F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"))


def audit_counts(spark: SparkSession, out_dir: str, checkpoint_dir: str | None = None,
                 read_table: Callable[[str], DataFrame | None] | None = None) -> DataFrame:
    """``(table, key, state_count, table_count)`` of every key whose table row is missing, differs or has no state.

    ``read_table(name)`` gives a table kept elsewhere, e.g. in a database; the default are the stream's
    parquet tables.  Run it while the stream is stopped.  Streams with ``count_watermark_delay`` forget finished days, so
    there the rows without state are not reported."""
    root = checkpoint_dir or f"{out_dir}/_checkpoints"
    found = None
    for query, table in COUNTED.items():
        keys = TABLE_KEYS[table]
        loaded = spark.read.format("statestore").load(f"{root}/{query}")
        forgets = "day" in loaded.schema["key"].dataType.names
        state = counted_state(spark, f"{root}/{query}").withColumnRenamed("click_count", "state_count")
        rows = read_table(table) if read_table is not None else read_upserted(spark, f"{out_dir}/{table}", keys)
        if rows is None:
            rows = state.select(*keys, F.lit(None).cast("long").alias("click_count")).limit(0)
        rows = rows.select(*keys, F.col("click_count").alias("table_count"))
        both = state.join(rows, keys, "left" if forgets else "full_outer").where(~F.col("state_count").eqNullSafe(F.col("table_count")))
        key = F.to_json(F.struct(*keys))
        wrong = both.select(F.lit(table).alias("table"), key.alias("key"), "state_count", "table_count")
        found = wrong if found is None else found.unionByName(wrong)
    return found
