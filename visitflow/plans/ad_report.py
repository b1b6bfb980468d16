"""The ad-click analysis as one batch job over a table of clicks (the batch twin of
``visitflow.streaming.ad_stream``; the streaming tables must end up equal to these)."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from visitflow.operators.ads import (
    ad_minute_counts, ad_trend, blacklist_candidates, daily_ad_counts, filter_blacklisted,
    province_top_ads, region_ad_counts, user_ad_counts,
)

TABLES = (
    "ad_daily_count", "ad_province_top3", "ad_stat", "ad_user_click_count", "ad_click_trend",
    "ad_minute_count", "ad_blacklist",
)


def ad_report(
    spark: SparkSession,
    clicks: DataFrame,
    blacklist: DataFrame | None = None,
    out_dir: str | None = None,
    threshold: int = 100,
    top_n: int = 3,
    window_minutes: int = 60,
    parallel_writes: int = 3,
    write_table: Callable[[str, DataFrame, int], None] | None = None,
) -> dict[str, DataFrame]:
    """All ad tables from typed clicks.  Clicks of users in ``blacklist`` are removed first;
    ``ad_blacklist`` is the given blacklist grown by this data's heavy clickers.
    ``write_table(name, rows, 0)`` gets every table that was written to ``out_dir`` as well, e.g.
    ``jdbc_writer(url, execute)``."""
    clean = filter_blacklisted(clicks, blacklist) if blacklist is not None else clicks
    if out_dir is not None:
        # shared by the seven writes; lost blocks are recomputed from the scan
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
    daily = daily_ad_counts(clean)
    users = user_ad_counts(clean)
    grown = blacklist_candidates(users, threshold)
    if blacklist is not None:
        grown = grown.unionByName(blacklist.select("user_id")).distinct()
    outputs = {
        "ad_daily_count": daily,
        "ad_province_top3": province_top_ads(daily, top_n),
        "ad_stat": region_ad_counts(clean),
        "ad_user_click_count": users,
        "ad_click_trend": ad_trend(clean, window_minutes),
        "ad_minute_count": ad_minute_counts(clean),
        "ad_blacklist": grown,
    }
    if out_dir is None:
        return outputs  # lazy frames; caching them is the caller's choice

    def write(name: str, frame: DataFrame) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{out_dir}/{name}")
        return spark.read.parquet(f"{out_dir}/{name}")

    def wave(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write independent tables concurrently (Spark runs jobs from several threads)."""
        with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
            futures = {name: pool.submit(write, name, frame) for name, frame in frames.items()}
            return {name: f.result() for name, f in futures.items()}

    try:
        first = wave({name: outputs[name] for name in
                      ("ad_daily_count", "ad_user_click_count", "ad_stat", "ad_click_trend", "ad_minute_count")})
        # the ranking and the blacklist read the written count tables instead of aggregating again
        grown = blacklist_candidates(first["ad_user_click_count"], threshold)
        if blacklist is not None:
            grown = grown.unionByName(blacklist.select("user_id")).distinct()
        wave({"ad_province_top3": province_top_ads(first["ad_daily_count"], top_n), "ad_blacklist": grown})
    finally:
        clean.unpersist()
    written = {name: spark.read.parquet(f"{out_dir}/{name}") for name in TABLES}
    if write_table is not None:
        for name, rows in written.items():
            write_table(name, rows, 0)
    return written
