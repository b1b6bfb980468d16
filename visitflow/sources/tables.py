"""Loaders of the visit, user and blacklist tables (parquet, the reference's text form, a
catalog table, or JDBC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitflow.schemas import BLACKLIST_SCHEMA, USER_SCHEMA, VISIT_SCHEMA

# The text form is comma separated, one row per line (CRLF), no header, fields in the schema's order.
# Only the user id is ever read from the user table.
USER_REQUIRED = ("user_id",)
_TEXT_OPTIONS = {
    "header": "false",
    "mode": "PERMISSIVE",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


def _conform(df: DataFrame, schema: T.StructType, required: tuple[str, ...] | None = None) -> DataFrame:
    """Select the schema's columns in order with its types (extra columns are pruned).  Columns
    outside ``required`` (default: all) may be missing and then read as null."""
    required = tuple(f.name for f in schema.fields) if required is None else required
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_text_rows(spark: SparkSession, source: str, schema: T.StructType, counts=None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the text form: lines that do not hold the schema's fields, short ones and
    ones with a bad number or time among them, are set apart with their text in ``line``.

    ``counts`` (a ``plans.counts.TableCounts``) gets, under ``source``, the numbers of lines (``rows``) and of
    ``rejects`` from the first pass over the returned rows."""
    bad = "_bad_line"
    row = F.from_csv("value", T.StructType([*schema.fields, T.StructField(bad, T.StringType())]).simpleString()[len("struct<"):-1]
                     .replace(":", " "), {**_TEXT_OPTIONS, "columnNameOfCorruptRecord": bad})
    lines = spark.read.text(source).where(F.col("value") != "").select("value", row.alias("row"))
    good = lines
    if counts is not None:
        # the whole row is read here, so that pruning cannot drop the fields whose errors are counted
        good = counts.watch(source, lines, rejects=F.count_if(F.col(f"row.{bad}").isNotNull()))
    return (good.where(F.col(f"row.{bad}").isNull()).select("row.*").drop(bad),
            lines.where(F.col(f"row.{bad}").isNotNull()).select(F.col("value").alias("line")))


def _load(spark, source, fmt, schema, required, jdbc_options, counts=None) -> DataFrame:
    if fmt == "parquet":
        return _conform(spark.read.parquet(source), schema, required)
    if fmt == "csv":
        return read_text_rows(spark, source, schema, counts)[0]
    if fmt == "table":
        return _conform(spark.table(source), schema, required)
    if fmt == "jdbc":
        return _conform(read_jdbc(spark, source, jdbc_options), schema, required)
    if fmt == "database":
        return _read_database(spark, source, schema, jdbc_options)
    raise ValueError(f"unknown format {fmt!r}")


def read_jdbc(spark: SparkSession, source: str, options: dict[str, str] | None = None) -> DataFrame:
    """A database table, or a query in parentheses with an alias, through Spark's JDBC source
    (``url``, ``user``, ``partitionColumn`` ... in ``options``)."""
    return spark.read.format("jdbc").options(**{"dbtable": source, **(options or {})}).load()


def _read_database(spark: SparkSession, source: str, schema: T.StructType, options: dict[str, str] | None) -> DataFrame:
    """A table through ``visitflow.database`` (its ``register`` first): ranges of ``partitionColumn``, filters in the database."""
    return spark.read.format("visitflow_db").options(**{**(options or {}), "table": source}).schema(schema).load()


def load_visits(spark: SparkSession, source: str, fmt: str = "parquet", jdbc_options: dict[str, str] | None = None, counts=None) -> DataFrame:
    """Visits from a parquet path, the text form (``fmt="csv"``; bad lines are left out and counted
    in ``counts``, ``read_text_rows`` returns them), a catalog table or a database table (``fmt="jdbc"`` or ``"database"``)."""
    return _load(spark, source, fmt, VISIT_SCHEMA, None, jdbc_options, counts)


def load_users(spark: SparkSession, source: str, fmt: str = "parquet", jdbc_options: dict[str, str] | None = None, counts=None) -> DataFrame:
    """Users, from the same sources as visits; only the user id is required."""
    return _load(spark, source, fmt, USER_SCHEMA, USER_REQUIRED, jdbc_options, counts)


def load_blacklist(
    spark: SparkSession,
    source: str | None = None,
    fmt: str = "parquet",
    jdbc_options: dict[str, str] | None = None,
) -> DataFrame:
    """The blacklisted users (column ``user_id``).

    A missing parquet folder is an empty blacklist.  With ``fmt="jdbc"`` the table is read
    through Spark's JDBC source; used as the static side of a streaming join, a JDBC relation
    is re-read in every micro-batch, whereas a parquet listing is fixed when the query starts.
    ``fmt="database"`` reads it through ``visitflow.database``, also again in every micro-batch.
    """
    if fmt == "database":
        return _read_database(spark, source or "ad_blacklist", BLACKLIST_SCHEMA, jdbc_options)
    if fmt == "jdbc":
        return _conform(read_jdbc(spark, source or "ad_blacklist", jdbc_options), BLACKLIST_SCHEMA)
    if source is None:
        return spark.createDataFrame([], BLACKLIST_SCHEMA)
    if fmt == "parquet":
        try:
            df = spark.read.parquet(source)
        except Exception as exc:  # noqa: BLE001 - only "path does not exist" is expected
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return spark.createDataFrame([], BLACKLIST_SCHEMA)
            raise
        return _conform(df, BLACKLIST_SCHEMA)
    if fmt == "table":
        return _conform(spark.table(source), BLACKLIST_SCHEMA)
    raise ValueError(f"unknown format {fmt!r}")
