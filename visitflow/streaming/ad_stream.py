"""The ad-click stream: click lines -> parsed, blacklist-filtered clicks -> running counts, the
top ads of each province and day, the sliding one-hour trend, and a growing blacklist.

Topology (each query has its own checkpoint under ``checkpoint_dir``):

``clean``   lines -> ``parse_click_lines`` -> stream-static left anti join with the blacklist
            -> parquet file sink ``clean_clicks``; ``rejected`` writes the bad lines to
            ``rejected_lines``.  The blacklist is a catalog table partitioned by batch, whose
            partitions Spark resolves again at every micro-batch: a user detected in one batch
            is blocked from the next one on.  The file sink is exactly once (its commit log
            skips a replayed batch) and the counting queries read that log instead of listing
            the folder.
``daily``   clean clicks -> running count per (date, province, ad) in the state store ->
            upsert ``ad_daily_count``; the touched (date, province) groups are re-ranked from
            that table and replaced in ``ad_province_top3``.
``region``  running count per (date, province, city, ad) -> upsert ``ad_stat``.
``user``    running count per (date, user, ad) -> upsert ``ad_user_click_count``; users at or
            over the threshold are added to ``ad_blacklist`` (the feedback loop).
``trend``   clicks per minute, then the sliding hour over the minutes, per (date, ad); each window
            is written to ``ad_click_trend`` once, when the watermark closes it.
``minute``  count per (date, ad, minute) -> upsert ``ad_minute_count``.

The counts run in ``update`` mode and write running totals keyed by the table key, so a replayed
micro-batch rewrites the same values.  A date's log is folded before it grows beyond a fixed number
of batches, and a micro-batch reads the folders of its own dates alone.

``heavy``   (``detect="state"``) instead of the counts' threshold: ``transformWithState`` reports a user at
            the click that makes them heavy, once, and forgets days that have ended.

With a ``database`` the tables live there instead: their rows carry the query and epoch that wrote them, so a
replayed or late task changes nothing (``visitflow.database``), and the blacklist is read again from the
database in every micro-batch.  No log of batches is kept.

``trend`` and ``minute`` hold windows, so they need ``watermark_delay``: state of windows that the
watermark has passed is dropped, and so are clicks later than that, whose number
``AdStream.late_clicks()`` reports.  The running totals are kept for ever unless
``count_watermark_delay`` bounds them in the same way, by day.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitflow.database import Database, register, stream_query
from visitflow.functions.predicates import all_not_null
from visitflow.operators.ads import ad_minute_counts, ad_trend, filter_blacklisted, province_top_ads
from visitflow.schemas import BLACKLIST_SCHEMA, CLICK_SCHEMA, TABLE_KEYS
from visitflow.sinks.parquet import (
    BATCH_COL, fold, folder_exists, read_groups, read_upserted, replace_groups, upsert,
)
from visitflow.sources.clicks import TYPED_COLUMNS, parse_click_lines
from visitflow.streaming.heavy import heavy_clickers

DAILY_KEYS = TABLE_KEYS["ad_daily_count"]
REGION_KEYS = TABLE_KEYS["ad_stat"]
USER_KEYS = TABLE_KEYS["ad_user_click_count"]
GROUP_KEYS = TABLE_KEYS["ad_province_groups"]
TREND_KEYS = TABLE_KEYS["ad_click_trend"]
MINUTE_KEYS = TABLE_KEYS["ad_minute_count"]
# Every count table is laid out by date, then by micro-batch: readers of some dates prune the rest.
DATE_PARTITION = ["click_date"]


@dataclass
class AdStream:
    """Handles of the running queries and where their tables are."""

    out_dir: str
    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    blacklist_table: str | None = None

    def table(self, name: str) -> str:
        return f"{self.out_dir}/{name}"

    def await_all(self, timeout: float | None = None) -> None:
        """Wait until every query has ended, ``timeout`` seconds at most.  If one fails, the others
        are stopped and its error is raised."""
        end = None if timeout is None else time.monotonic() + timeout
        while True:
            for name, q in self.queries.items():
                if (error := q.exception()) is not None:
                    self.stop()
                    raise RuntimeError(f"query {name} failed") from error
            if not any(q.isActive for q in self.queries.values()) or (end is not None and time.monotonic() > end):
                return
            time.sleep(0.2)

    def late_clicks(self) -> dict[str, int]:
        """By query: rows that came after the watermark had passed them, in the batches that Spark
        still reports."""
        return {name: sum(int(op["numRowsDroppedByWatermark"]) for p in q.recentProgress for op in p["stateOperators"])
                for name, q in self.queries.items()}

    def process_all_available(self) -> None:
        """Block until every query has processed what is available now: the parsing queries
        first, then the counting queries that read their output."""
        for name in ("clean", "rejected"):
            if name in self.queries:
                self.queries[name].processAllAvailable()
        for name, q in self.queries.items():
            if name not in ("clean", "rejected"):
                q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries.values():
            if q.isActive:
                q.stop()


def blacklist_table_name(out_dir: str) -> str:
    """Default catalog name of the stream's blacklist table (one per output folder)."""
    return "visitflow_blacklist_" + hashlib.md5(out_dir.encode()).hexdigest()[:12]


def ensure_blacklist_table(spark: SparkSession, table: str, path: str) -> None:
    """The blacklist as a parquet catalog table at ``path``, partitioned by batch.  A stream-static
    join resolves a partitioned catalog table's partitions again at every micro-batch, so users
    added by the ``user`` query are filtered from the next batch on (a plain parquet path would
    keep the file list it had when the query started)."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (user_id BIGINT, {BATCH_COL} BIGINT) USING parquet "
        f"PARTITIONED BY ({BATCH_COL}) LOCATION '{path}'"
    )
    location = _table_location(spark, table)
    if location is not None and _norm_path(location) != _norm_path(path):
        raise ValueError(f"table {table} already exists at {location}, not at {path}")
    try:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")  # batches written by an earlier session
    except Exception as exc:  # noqa: BLE001 - a first run has no folder yet
        if "does not exist" not in str(exc) and "FileNotFound" not in str(exc):
            raise


def _table_location(spark: SparkSession, table: str) -> str | None:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row[0] == "Location":
            return row[1]
    return None


def _norm_path(path: str) -> str:
    """Compare locations without the local-file scheme and repeated or trailing slashes."""
    if path.startswith("file:"):
        path = path[len("file:"):]
    scheme, sep, rest = path.partition("://")
    if not sep:
        scheme, rest = "", path
    rest = re.sub("/+", "/", rest).rstrip("/")
    return f"{scheme}://{rest}" if sep else rest


def current_blacklist(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select("user_id").distinct()


def _counted(clicks: DataFrame, keys: list[str], watermark_delay: str | None) -> DataFrame:
    """Running count per key; with a watermark the day window is part of the state key so the
    state of a finished day can be dropped (the day window equals ``click_date`` in UTC)."""
    clicks = clicks.where(all_not_null(*keys))
    if watermark_delay:
        grouped = clicks.withWatermark("ts", watermark_delay).groupBy(F.window("ts", "1 day").alias("day"), *keys)
    else:
        grouped = clicks.groupBy(*keys)
    return grouped.agg(F.count(F.lit(1)).alias("click_count"))


def _dates(changed: DataFrame) -> list:
    """The dates of a micro-batch: one value for each calendar day of its clicks."""
    return sorted(r[0] for r in changed.select("click_date").distinct().collect())


def _logged(name: str, path: str, keys: list[str], rows: DataFrame, batch_id: int, dates: list, write_table) -> None:
    """One micro-batch into a count table: long logs of its dates are folded, then it is written."""
    fold(rows.sparkSession, path, keys, batch_id, DATE_PARTITION[0], dates)
    upsert(rows, path, keys, batch_id, partition_by=DATE_PARTITION)
    if write_table is not None:
        write_table(name, rows, batch_id)


def _daily_batch(out_dir: str, top_n: int, write_table):
    daily_path, top_path = f"{out_dir}/ad_daily_count", f"{out_dir}/ad_province_top3"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.select(*DAILY_KEYS, "click_count").persist()
        try:
            dates = _dates(changed)
            _logged("ad_daily_count", daily_path, DAILY_KEYS, changed, batch_id, dates, write_table)
            if not dates:
                return
            # re-rank only the (date, province) groups this batch touched, reading only their dates
            touched = changed.select(*GROUP_KEYS).distinct()
            current = read_upserted(spark, daily_path, DAILY_KEYS, only=touched, date_col=DATE_PARTITION[0], dates=dates)
            top = province_top_ads(current, top_n)
            fold(spark, top_path, GROUP_KEYS, batch_id, DATE_PARTITION[0], dates, groups=True)
            replace_groups(top, top_path, GROUP_KEYS, batch_id, partition_by=DATE_PARTITION)
            if write_table is not None:
                write_table("ad_province_top3", top, batch_id)
        finally:
            changed.unpersist()

    return run


def _upsert_batch(name: str, path: str, keys: list[str], columns: list[str], write_table):
    def run(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*columns).persist()
        try:
            _logged(name, path, keys, changed, batch_id, _dates(changed), write_table)
        finally:
            changed.unpersist()

    return run


def _user_batch(out_dir: str, threshold: int | None, blacklist_table: str, write_table):
    """Counts per user; with ``threshold`` users that reach it are listed."""
    counts_path = f"{out_dir}/ad_user_click_count"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.select(*USER_KEYS, "click_count").persist()
        try:
            _logged("ad_user_click_count", counts_path, USER_KEYS, changed, batch_id, _dates(changed), write_table)
            # a listed user whose count keeps growing is not written again (compared with the
            # table before this batch).  The table is a set read with ``distinct``: a replayed
            # batch may append its users a second time, which changes nothing.  (Spark does not
            # let a write overwrite a table it also reads, even another partition of it.)
            if threshold is not None:
                heavy = changed.where(F.col("click_count") >= int(threshold)).select("user_id").distinct()
                _list_users(spark, heavy, batch_id, blacklist_table, write_table)
        finally:
            changed.unpersist()

    return run


def _list_users(spark: SparkSession, heavy: DataFrame, batch_id: int, blacklist_table: str, write_table) -> None:
    """Add the users that the blacklist table did not have before this batch."""
    known = spark.table(blacklist_table).where(F.col(BATCH_COL) < int(batch_id)).select("user_id")
    new = heavy.join(known, "user_id", "left_anti")
    if write_table is not None:  # before the own table: a replay must write them again
        write_table("ad_blacklist", new, batch_id)
    new.select("user_id", F.lit(int(batch_id)).cast("long").alias(BATCH_COL)).write.insertInto(blacklist_table)


def _heavy_batch(blacklist_table: str, write_table):
    def run(batch: DataFrame, batch_id: int) -> None:
        found = batch.select("user_id").persist()
        try:
            _list_users(batch.sparkSession, found, batch_id, blacklist_table, write_table)
        finally:
            found.unpersist()

    return run


def _daily_into(database: Database, top_n: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, stream_query(batch.sparkSession)
        changed = batch.select(*DAILY_KEYS, "click_count").persist()
        try:
            database.upsert(changed, "ad_daily_count", DAILY_KEYS, batch_id, query)
            dates = _dates(changed)
            if not dates:
                return
            # the dates are a filter of the database's query
            current = database.read(spark, "ad_daily_count", changed.schema).where(F.col("click_date").isin(dates))
            touched = changed.select(*GROUP_KEYS).distinct()
            top = province_top_ads(current.join(touched, GROUP_KEYS, "left_semi"), top_n)
            database.replace_groups(top, "ad_province_top3", GROUP_KEYS, batch_id, query)
        finally:
            changed.unpersist()

    return run


def _user_into(database: Database, threshold: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        query = stream_query(batch.sparkSession)
        changed = batch.select(*USER_KEYS, "click_count").persist()
        try:
            database.upsert(changed, "ad_user_click_count", USER_KEYS, batch_id, query)
            heavy = changed.where(F.col("click_count") >= int(threshold)).select("user_id").distinct()
            database.upsert(heavy, "ad_blacklist", TABLE_KEYS["ad_blacklist"], batch_id, query)
        finally:
            changed.unpersist()

    return run


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = "spark.sql.streaming.stateStore.providerClass"


def _choose_state_store(spark: SparkSession, state_store: str) -> None:
    """Use RocksDB for the running counts unless the session already names a provider."""
    if state_store != "rocksdb":
        return
    current = spark.conf.get(_STATE_CONF, None)
    if current is None or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_STATE_CONF, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _tie_checkpoint(spark: SparkSession, out_dir: str, ckpt: str) -> None:
    """Refuse tables without their checkpoint and checkpoints of other tables; note whose it is."""
    if folder_exists(spark, f"{out_dir}/clean_clicks/_spark_metadata") and not folder_exists(spark, f"{ckpt}/clean/metadata"):
        raise ValueError(f"{out_dir} holds tables of a stream, but {ckpt} is not its checkpoint")
    owner = f"{ckpt}/_stream"
    if folder_exists(spark, owner):
        known = spark.read.text(owner).first()[0]
        if known != _norm_path(out_dir):
            raise ValueError(f"{ckpt} is the checkpoint of the stream at {known}, not of {out_dir}")
    else:
        spark.createDataFrame([(_norm_path(out_dir),)], "value string").coalesce(1).write.text(owner)


def start_ad_stream(
    spark: SparkSession,
    lines: DataFrame,
    out_dir: str,
    checkpoint_dir: str | None = None,
    trigger: dict | None = None,
    threshold: int = 100,
    apply_blacklist: bool = True,
    watermark_delay: str = "1 day",
    top_n: int = 3,
    window_minutes: int = 60,
    wait_for_clean: bool | None = None,
    max_files_per_trigger: int | None = None,
    blacklist_loader=None,
    state_store: str = "rocksdb",
    trend_method: str = "chain",
    blacklist_table: str | None = None,
    count_watermark_delay: str | None = None,
    write_table: Callable[[str, DataFrame, int], None] | None = None,
    database: Database | None = None,
    detect: str = "counts",
) -> AdStream:
    """Start the ad stream on ``lines`` (a streaming frame with a ``value`` column, e.g. from
    ``read_click_stream`` or ``read_click_files``).

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: every 5 seconds, as the
    reference).  With ``availableNow`` the ``clean`` query is run to the end before the counting
    queries start (``wait_for_clean``), so each run of the job sees the whole input.

    The blacklist is the catalog table ``blacklist_table`` (default: a name derived from
    ``out_dir``) stored at ``out_dir/ad_blacklist``.  ``blacklist_loader(spark) -> DataFrame``
    replaces it as the static side of the join; it must be a relation Spark resolves again per
    micro-batch, such as a JDBC table (``load_blacklist(spark, "ad_blacklist", fmt="jdbc", ...)``)
    or another partitioned catalog table.  ``state_store="rocksdb"`` keeps the
    running counts in RocksDB on local disk instead of the JVM heap (set on first start only; a
    query keeps the provider recorded in its checkpoint).

    The checkpoints are in ``checkpoint_dir``, by default ``out_dir/_checkpoints``: a stream
    started again over the same ``out_dir`` goes on where it ended.  It is refused if ``out_dir``
    holds its tables but the checkpoint is gone or belongs to another ``out_dir``, for then
    batches would be skipped or counted twice.

    ``watermark_delay`` bounds the state of ``trend`` and ``minute``.  ``trend_method="chain"``
    counts one-minute windows first and slides over those: each window is written once, when the
    watermark closes it.  ``"window"`` keeps every sliding window, 60 times the state, and
    rewrites its running count each batch (``update`` mode).  ``count_watermark_delay`` drops the
    state of finished days of the other counts.

    ``write_table(name, rows, batch_id)`` gets the changed rows of every table in every
    micro-batch, e.g. ``jdbc_writer(url, execute)``; a replayed batch gives the same rows again.
    New users of ``ad_blacklist`` come the same way, so a ``blacklist_loader`` that reads the
    database sees them.

    ``database`` keeps all result tables there (created if missing) instead of under ``out_dir``, which then holds
    the clean clicks, the rejected lines and the checkpoints; every replayed epoch leaves them as they are.
    ``detect="state"`` finds heavy clickers by ``streaming.heavy`` and needs ``state_store="rocksdb"``."""
    if detect not in ("counts", "state"):
        raise ValueError(f"unknown detect {detect!r}")
    if spark.conf.get("spark.sql.session.timeZone").upper() not in ("UTC", "ETC/UTC", "Z", "GMT", "+00:00"):
        raise ValueError("the ad stream counts days in UTC: set spark.sql.session.timeZone to UTC")
    if not watermark_delay:
        raise ValueError("the windows of trend and minute need watermark_delay")
    trigger = trigger or {"processingTime": "5 seconds"}
    if wait_for_clean is None:
        wait_for_clean = bool(trigger.get("availableNow") or trigger.get("once"))
    ckpt = checkpoint_dir or f"{out_dir}/_checkpoints"
    _tie_checkpoint(spark, out_dir, ckpt)
    _choose_state_store(spark, state_store)
    handle = AdStream(out_dir)

    def start(name: str, frame: DataFrame, fn, mode: str = "update") -> None:
        handle.queries[name] = (
            frame.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{ckpt}/{name}")
            .trigger(**trigger)
            .foreachBatch(fn)
            .start()
        )

    clean_path, rejected_path = handle.table("clean_clicks"), handle.table("rejected_lines")
    table = blacklist_table or blacklist_table_name(out_dir)
    if database is None:
        ensure_blacklist_table(spark, table, handle.table("ad_blacklist"))
        handle.blacklist_table = table
    else:
        register(spark)
        database.create_table("ad_blacklist", BLACKLIST_SCHEMA, TABLE_KEYS["ad_blacklist"])
        blacklist_loader = blacklist_loader or (lambda session: database.read(session, "ad_blacklist", BLACKLIST_SCHEMA))

    def sink(name: str, frame: DataFrame, path: str) -> None:
        # Spark's file sink: exactly once through its commit log, which readers use instead of
        # listing the folder
        handle.queries[name] = (
            frame.writeStream.format("parquet").outputMode("append")
            .option("path", path)
            .option("checkpointLocation", f"{ckpt}/{name}")
            .trigger(**trigger)
            .start()
        )

    parsed = parse_click_lines(lines)
    good = parsed.where(F.col("parse_error").isNull()).select(*TYPED_COLUMNS)
    if apply_blacklist:
        static = blacklist_loader(spark) if blacklist_loader is not None else spark.table(table)
        good = filter_blacklisted(good, static)
    sink("clean", good, clean_path)
    sink("rejected", parsed.where(F.col("parse_error").isNotNull()).select("line", "parse_error"), rejected_path)
    if wait_for_clean:
        handle.queries["clean"].awaitTermination()
        handle.queries["rejected"].awaitTermination()

    reader = spark.readStream.schema(CLICK_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    clicks = reader.parquet(clean_path)
    timed = clicks.withWatermark("ts", watermark_delay)
    heavy = heavy_clickers(clicks, threshold, watermark_delay) if detect == "state" else None
    trend = ad_trend(timed, window_minutes, method="window_chain" if trend_method == "chain" else "window")
    trend_mode = "append" if trend_method == "chain" else "update"
    if database is not None:
        def keep(name: str, table_name: str, frame: DataFrame, mode: str = "update") -> None:
            keys = TABLE_KEYS[table_name]
            frame = frame.select(*dict.fromkeys([*keys, *(c for c in ("minute", "click_count") if c in frame.columns)]))
            database.create_table(table_name, frame.schema, keys)
            handle.queries[name] = database.stream(frame, table_name, f"{ckpt}/{name}", keys, mode).trigger(**trigger).start()

        daily, users = (_counted(clicks, keys, count_watermark_delay) for keys in (DAILY_KEYS, USER_KEYS))
        for table_name, frame, keys in (("ad_daily_count", daily, DAILY_KEYS), ("ad_province_top3", daily, DAILY_KEYS),
                                        ("ad_user_click_count", users, USER_KEYS)):
            database.create_table(table_name, frame.select(*keys, "click_count").schema, TABLE_KEYS[table_name])
        start("daily", daily, _daily_into(database, top_n))
        if heavy is None:
            start("user", users, _user_into(database, threshold))
        else:
            keep("user", "ad_user_click_count", users)
            keep("heavy", "ad_blacklist", heavy, "append")
        keep("region", "ad_stat", _counted(clicks, REGION_KEYS, count_watermark_delay))
        keep("trend", "ad_click_trend", trend, trend_mode)
        keep("minute", "ad_minute_count", ad_minute_counts(timed))
        return handle
    start("daily", _counted(clicks, DAILY_KEYS, count_watermark_delay), _daily_batch(out_dir, top_n, write_table))
    start("region", _counted(clicks, REGION_KEYS, count_watermark_delay),
          _upsert_batch("ad_stat", handle.table("ad_stat"), REGION_KEYS, [*REGION_KEYS, "click_count"], write_table))
    start("user", _counted(clicks, USER_KEYS, count_watermark_delay),
          _user_batch(out_dir, threshold if heavy is None else None, table, write_table))
    if heavy is not None:
        start("heavy", heavy, _heavy_batch(table, write_table), mode="append")
    trend_sink = _upsert_batch("ad_click_trend", handle.table("ad_click_trend"), TREND_KEYS,
                               [*TREND_KEYS, "minute", "click_count"], write_table)
    start("trend", trend, trend_sink, mode=trend_mode)
    start("minute", ad_minute_counts(timed),
          _upsert_batch("ad_minute_count", handle.table("ad_minute_count"), MINUTE_KEYS, [*MINUTE_KEYS, "click_count"], write_table))
    return handle


def read_ad_tables(spark: SparkSession, out_dir: str, blacklist_table: str | None = None) -> dict[str, DataFrame | None]:
    """Current contents of the stream's result tables."""
    return {
        "ad_daily_count": read_upserted(spark, f"{out_dir}/ad_daily_count", DAILY_KEYS),
        "ad_province_top3": read_groups(spark, f"{out_dir}/ad_province_top3", GROUP_KEYS),
        "ad_stat": read_upserted(spark, f"{out_dir}/ad_stat", REGION_KEYS),
        "ad_user_click_count": read_upserted(spark, f"{out_dir}/ad_user_click_count", USER_KEYS),
        "ad_click_trend": read_upserted(spark, f"{out_dir}/ad_click_trend", TREND_KEYS),
        "ad_minute_count": read_upserted(spark, f"{out_dir}/ad_minute_count", MINUTE_KEYS),
        "ad_blacklist": current_blacklist(spark, blacklist_table or blacklist_table_name(out_dir)),
    }
