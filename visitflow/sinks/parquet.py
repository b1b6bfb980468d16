"""Result tables on parquet: replace by task, keyed upsert, and replace-by-group.

Spark's parquet writer has no upsert, so keyed tables are kept as a log partitioned by
``batch_id``: every (micro-)batch writes the rows it changes into its own partition with dynamic
partition overwrite, and readers take, per key, the row of the highest batch.  Writing batch
``N`` twice (a replayed micro-batch) replaces partition ``N`` with the same rows, so replays
are idempotent without any bookkeeping; writing costs O(changed rows), never a rewrite of the
table.  ``fold`` keeps the log of a date short: before a batch is written, a date with more than
``FOLD_ABOVE`` batches since the last fold gets its current rows appended to its last batch; the others are
deleted one fold later, so a reader that has listed them still finds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "batch_id"
#: A date is folded when it has more batches since its last fold; its log holds at most twice as many and a few.
FOLD_ABOVE = 12
#: A file of this name and a batch id, beside the batches, notes a fold into that batch.
_FOLDED = "_folded_"


def _writer(df: DataFrame, partition_cols: Sequence[str]):
    return (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
    )


def _check_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"key columns missing from the frame: {missing}")


def replace_task(df: DataFrame, path: str, task_id: int) -> None:
    """Write ``df`` as all rows of one task: the folder ``task_id=<id>`` is replaced, also by an
    empty result."""
    df.drop("task_id").write.mode("overwrite").parquet(f"{path}/task_id={int(task_id)}")


def read_task(spark: SparkSession, path: str, schema: T.StructType, task_id: int) -> DataFrame:
    """The rows of one task, with the declared schema (``task_id`` is the first column)."""
    stored = T.StructType([f for f in schema.fields if f.name != "task_id"])
    rows = spark.read.schema(stored).parquet(f"{path}/task_id={int(task_id)}")
    return rows.select(F.lit(int(task_id)).alias("task_id"), *stored.names)


def upsert(
    df: DataFrame, path: str, keys: Sequence[str], batch_id: int, partition_by: Sequence[str] = ()
) -> None:
    """Insert or replace the rows of ``df`` by ``keys`` (batch ``batch_id`` of the log).

    ``df`` must hold at most one row per key (e.g. running totals of a streaming aggregate).
    ``partition_by`` (a part of the key, e.g. the date) lays the log out so that readers that
    need a few of its values prune the other folders."""
    _check_columns(df, [*keys, *partition_by])
    logged = df.withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
    _writer(logged, [*partition_by, BATCH_COL]).parquet(path)


def replace_groups(
    df: DataFrame, path: str, group_keys: Sequence[str], batch_id: int, partition_by: Sequence[str] = ()
) -> None:
    """Replace every group of ``group_keys`` present in ``df`` by its rows in ``df``.

    Readers see, per group, only the rows of the last batch that wrote the group."""
    _check_columns(df, [*group_keys, *partition_by])
    _writer(df.withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long")), [*partition_by, BATCH_COL]).parquet(path)


def _folder(spark: SparkSession, path: str):
    """The file system of ``path`` and the path, for listing and deleting."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def batches_of(spark: SparkSession, path: str) -> list[int]:
    """The batch ids below a folder (one date of a log)."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BATCH_COL}="))


def fold(
    spark: SparkSession, path: str, keys: Sequence[str], batch_id: int, date_col: str, dates: Sequence,
    groups: bool = False, above: int = FOLD_ABOVE,
) -> None:
    """Shorten the logs of ``dates`` before batch ``batch_id`` is written.

    A date with more than ``above`` earlier batches since its last fold gets its current rows appended to the last of
    them, then the fold is noted, and only then are the batches deleted that the fold before had made superfluous:
    a reader that listed the folder since then finds its files.  A crash in between leaves rows that agree
    with each other, and earlier batches are never written again, so a replay folds to the same rows.
    ``dates`` are those of one micro-batch; no other folder is listed."""
    for date in dates:
        folder = f"{path}/{date_col}={date}"
        earlier = [b for b in batches_of(spark, folder) if b < int(batch_id)]
        noted = _folds_of(spark, folder)
        last = max(noted, default=-1)
        if sum(b > last for b in earlier) <= above:
            continue
        current = [b for b in earlier if b >= last]  # the fold into ``last`` holds what came before
        log = spark.read.option("basePath", path).parquet(*(f"{folder}/{BATCH_COL}={b}" for b in current))
        rows = _last_groups(log, keys) if groups else _last_rows(log, keys)
        rows.select(*(c for c in rows.columns if c != date_col)).write.mode("append").parquet(f"{folder}/{BATCH_COL}={earlier[-1]}")
        fs, mark = _folder(spark, f"{folder}/{_FOLDED}{earlier[-1]}")
        fs.createNewFile(mark)
        for b in earlier:
            if b < last:
                fs.delete(_folder(spark, f"{folder}/{BATCH_COL}={b}")[1], True)
        for b in noted:
            fs.delete(_folder(spark, f"{folder}/{_FOLDED}{b}")[1], False)


def _folds_of(spark: SparkSession, folder: str) -> list[int]:
    """The batches into which a date was folded: one, or two after a crash."""
    fs, place = _folder(spark, folder)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(n[len(_FOLDED):]) for n in names if n.startswith(_FOLDED))


def _read_log(spark: SparkSession, path: str, date_col: str | None = None, dates: Sequence | None = None) -> DataFrame | None:
    """The log, or the folders of ``dates`` alone."""
    try:
        if dates is None:
            return spark.read.parquet(path)
        folders = [f for f in (f"{path}/{date_col}={d}" for d in dates) if folder_exists(spark, f)]
        return spark.read.option("basePath", path).parquet(*folders) if folders else None
    except Exception as exc:  # noqa: BLE001 - a table never written is empty
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def _last_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in log.columns if c not in keys and c != BATCH_COL]
    latest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in values]), F.col(BATCH_COL)).alias("_row")
    )
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def _last_groups(log: DataFrame, group_keys: Sequence[str]) -> DataFrame:
    last = log.groupBy(*group_keys).agg(F.max(BATCH_COL).alias(BATCH_COL))
    return log.join(last, [*group_keys, BATCH_COL], "left_semi").drop(BATCH_COL).distinct()


def read_upserted(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    only: DataFrame | None = None,
    date_col: str | None = None,
    dates: Sequence | None = None,
) -> DataFrame | None:
    """Current rows of an upsert table: per key, the row of the highest batch.

    ``max_by`` is combined map-side before the shuffle on the key, so a key rewritten in many
    batches costs one row per task, not one per batch.

    * ``only`` (a frame of some key columns) restricts the read to the keys it matches, with a
      semi join before the aggregation;
    * ``dates`` reads the folders of these values of ``date_col`` alone."""
    log = _read_log(spark, path, date_col, dates)
    if log is None:
        return None
    if only is not None:
        log = log.join(only, list(only.columns), "left_semi")
    return _last_rows(log, keys)


def read_groups(spark: SparkSession, path: str, group_keys: Sequence[str]) -> DataFrame | None:
    """Current rows of a replace-by-group table: the rows of each group's last batch.

    The last batch per group is a partial aggregate; the rows are then found with an equi join
    on (group, batch), so a group written by many batches is spread over those batches."""
    log = _read_log(spark, path)
    return None if log is None else _last_groups(log, group_keys)
