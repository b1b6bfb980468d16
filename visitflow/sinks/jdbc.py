"""Result tables in a relational database over JDBC.

Appends use Spark's JDBC writer (one connection per task, batched inserts).  Spark's writer has
no upsert or group replace, so those write the batch to a staging table from the executors and
then run set-based statements in the database, in one transaction: ``MERGE`` (or MySQL's
``INSERT ... ON DUPLICATE KEY UPDATE``) for an upsert, ``DELETE`` of the staged groups plus
``INSERT`` for a group replace.  A replayed batch stages and applies the same rows again.

``execute(statements)`` is supplied by the application: it runs the statements in one
transaction on its own connection (the library opens none).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from visitflow.schemas import TABLE_KEYS

Executor = Callable[[Sequence[str]], None]


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties or {})


def merge_sql(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """ANSI ``MERGE`` from ``staging`` into ``table`` on ``keys``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    values = [c for c in columns if c not in keys]
    update = ", ".join(f"{c} = s.{c}" for c in values)
    cols = ", ".join(columns)
    src = ", ".join(f"s.{c}" for c in columns)
    matched = f" WHEN MATCHED THEN UPDATE SET {update}" if values else ""
    return (f"MERGE INTO {table} t USING {staging} s ON {on}{matched} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({src})")


def mysql_upsert_sql(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """MySQL ``INSERT ... SELECT ... ON DUPLICATE KEY UPDATE`` (the table's primary key is
    ``keys``)."""
    cols = ", ".join(columns)
    values = [c for c in columns if c not in keys] or list(keys)
    update = ", ".join(f"{c} = VALUES({c})" for c in values)
    return f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} ON DUPLICATE KEY UPDATE {update}"


def replace_groups_sql(table: str, staging: str, group_keys: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Delete every group present in ``staging`` from ``table``, then insert the staged rows."""
    match = " AND ".join(f"s.{k} = {table}.{k}" for k in group_keys)
    cols = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {match})",
        f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}",
    ]


def _staging_name(table: str, batch_id: int | None) -> str:
    return f"{table}_staging" if batch_id is None else f"{table}_staging_{int(batch_id)}"


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    execute: Executor,
    properties: dict[str, str] | None = None,
    dialect: str = "ansi",
    batch_id: int | None = None,
) -> None:
    """Stage ``df`` and merge it into ``table`` by ``keys``."""
    staging = _staging_name(table, batch_id)
    df.write.jdbc(url, staging, mode="overwrite", properties=properties or {})
    build = mysql_upsert_sql if dialect == "mysql" else merge_sql
    execute([build(table, staging, keys, df.columns)])
    execute([f"DROP TABLE {staging}"])


def replace_groups_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    group_keys: Sequence[str],
    execute: Executor,
    properties: dict[str, str] | None = None,
    batch_id: int | None = None,
) -> None:
    """Stage ``df`` and replace the groups it holds in ``table`` (one transaction)."""
    staging = _staging_name(table, batch_id)
    df.write.jdbc(url, staging, mode="overwrite", properties=properties or {})
    execute(replace_groups_sql(table, staging, group_keys, df.columns))
    execute([f"DROP TABLE {staging}"])


def jdbc_writer(
    url: str, execute: Executor, properties: dict[str, str] | None = None, dialect: str = "ansi"
) -> Callable[[str, DataFrame, int], None]:
    """A ``write_table(name, rows, batch_id)`` for the ad tables: the ranked groups are replaced,
    every other table is merged by its key."""

    def write(name: str, rows: DataFrame, batch_id: int) -> None:
        if name == "ad_province_top3":
            replace_groups_jdbc(rows, url, name, TABLE_KEYS["ad_province_groups"], execute, properties, batch_id)
        else:
            upsert_jdbc(rows, url, name, TABLE_KEYS[name], execute, properties, dialect, batch_id)

    return write
