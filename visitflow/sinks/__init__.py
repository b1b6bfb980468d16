"""Sinks: parquet replace-by-task / upsert / replace-by-group tables, and JDBC."""

from visitflow.sinks.jdbc import (
    append_jdbc, jdbc_writer, merge_sql, mysql_upsert_sql, replace_groups_jdbc, replace_groups_sql, upsert_jdbc,
)
from visitflow.sinks.parquet import (
    BATCH_COL, batches_of, fold, read_groups, read_task, read_upserted, replace_groups, replace_task, upsert,
)

__all__ = [
    "BATCH_COL", "append_jdbc", "batches_of", "fold", "jdbc_writer", "merge_sql",
    "mysql_upsert_sql", "read_groups", "read_task", "read_upserted", "replace_groups",
    "replace_groups_jdbc", "replace_groups_sql", "replace_task", "upsert", "upsert_jdbc",
]
