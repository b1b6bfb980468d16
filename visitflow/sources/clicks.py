"""Ad clicks: the wire format ``province,city,userId,adId,epochMillis`` and its sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.functions.timecols import epoch_ms_to_ts

CLICK_FIELDS = 5
# Spark's timestamp range, 0001-01-01 00:00:00 to 9999-12-31 23:59:59.999 UTC, in
# epoch milliseconds.  A click outside it is rejected instead of failing the job on overflow.
MIN_TS_MS = -62135596800000
MAX_TS_MS = 253402300799999
TYPED_COLUMNS = ["province", "city", "user_id", "ad_id", "ts_ms", "ts", "click_date"]


def _ts_ms_in_range(ts_ms: Column) -> Column:
    return ts_ms.between(MIN_TS_MS, MAX_TS_MS)


def with_click_time(df: DataFrame, checked: bool = True) -> DataFrame:
    """Add ``ts`` (instant) and ``click_date`` (its UTC date) from ``ts_ms``.  ``checked`` makes
    ``ts`` null outside the timestamp range (needed for parsed input; about 20% of the ad queries'
    time, so ``checked=False`` where ``ts_ms`` was derived from a timestamp column)."""
    ts = epoch_ms_to_ts(F.col("ts_ms"))
    if checked:
        ts = F.when(_ts_ms_in_range(F.col("ts_ms")), ts)
    return df.withColumns({"ts": ts, "click_date": F.to_date(ts)})


def click_line(province: Column, city: Column, user_id: Column, ad_id: Column, ts_ms: Column) -> Column:
    """Print a click in the wire format; a null field prints as an empty field."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (province, city, user_id, ad_id, ts_ms)]
    return F.concat_ws(",", *fields)


def parse_click_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split each line into typed fields and name the first problem in ``parse_error``
    (null for a good line).  Works on batch and streaming frames; all built-in expressions."""
    value = F.col(value_col)
    # like the wire format's original reader, trailing empty fields do not count ("a,b,1,2,3,"
    # is a 5-field click); an empty field inside the line still does
    parts = F.split(F.regexp_replace(value, ",+$", ""), ",", -1)
    user_id = F.get(parts, 2).try_cast("long")
    ad_id = F.get(parts, 3).try_cast("long")
    ts_ms = F.get(parts, 4).try_cast("long")
    error = (
        F.when(value.isNull() | (value == ""), F.lit("empty"))
        .when(F.size(parts) != CLICK_FIELDS, F.lit("field_count"))
        .when(user_id.isNull(), F.lit("user_id"))
        .when(ad_id.isNull(), F.lit("ad_id"))
        .when(ts_ms.isNull() | ~_ts_ms_in_range(ts_ms), F.lit("ts_ms"))
    )
    parsed = lines.select(
        value.alias("line"),
        F.get(parts, 0).alias("province"),
        F.get(parts, 1).alias("city"),
        user_id.alias("user_id"),
        ad_id.alias("ad_id"),
        ts_ms.alias("ts_ms"),
        error.alias("parse_error"),
    )
    return with_click_time(parsed)


def parse_clicks(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(typed clicks, rejected lines).  Rejected lines keep the text and the reason, so they
    can be counted (``rejects.groupBy("parse_error").count()``) or written aside."""
    parsed = parse_click_lines(lines, value_col)
    good = parsed.where(F.col("parse_error").isNull()).select(*TYPED_COLUMNS)
    bad = parsed.where(F.col("parse_error").isNotNull()).select("line", "parse_error")
    return good, bad


def read_click_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = "advice",
    starting_offsets: str = "latest",
    extra_options: dict[str, str] | None = None,
) -> DataFrame:
    """Kafka topic as a streaming frame of ``(key, value)`` strings.

    Needs the spark-sql-kafka connector on the classpath.  The reference's producer wrote to
    topic ``ad`` while its job read ``advice``; the topic is a parameter here."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for key, val in (extra_options or {}).items():
        reader = reader.option(key, val)
    try:
        stream = reader.load()
    except Exception as exc:  # noqa: BLE001
        text = str(exc).lower()
        if "kafka" in text and ("failed to find data source" in text or "data_source_not_found" in text):
            raise RuntimeError(
                "the Kafka source needs the spark-sql-kafka-0-10 connector on the classpath "
                "(for example spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>)"
            ) from exc
        raise
    return stream.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def read_click_files(
    spark: SparkSession, path: str, streaming: bool = True, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Text files of click lines (one per line) as a ``value`` column, batch or streaming."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
