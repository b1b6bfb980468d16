"""Ad-click operators over typed clicks (``province city user_id ad_id ts_ms ts click_date``).

The counting functions use only ``where``/``groupBy``/``count`` and therefore accept batch and
streaming frames alike; rankings (``province_top_ads``) need a batch frame (inside
``foreachBatch`` when streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.functions.predicates import all_not_null
from visitflow.functions.timecols import as_wall_time, minute_of


def _count_by(clicks: DataFrame, *keys: str) -> DataFrame:
    """Clicks per key (null keys dropped); partial counts are combined before the shuffle."""
    return clicks.where(all_not_null(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))


def filter_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks whose user is not on the blacklist (left anti join on ``user_id``; duplicate
    blacklist rows change nothing, an empty blacklist lets everything through)."""
    users = blacklist.select(F.col("user_id").alias("_listed_user")).where(F.col("_listed_user").isNotNull())
    # an expression join (not a using-column join) keeps the click columns in their order
    return clicks.join(users, F.col("user_id") == F.col("_listed_user"), "left_anti")


def daily_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per ``(click_date, province, ad_id)``."""
    return _count_by(clicks, "click_date", "province", "ad_id")


def region_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per ``(click_date, province, city, ad_id)``."""
    return _count_by(clicks, "click_date", "province", "city", "ad_id")


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per ``(click_date, user_id, ad_id)``."""
    return _count_by(clicks, "click_date", "user_id", "ad_id")


def province_top_ads(daily_counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` ads with most clicks per ``(click_date, province)``, ties to the lower ad id.
    The literal rank bound is applied per map task before the shuffle (WindowGroupLimit)."""
    order = Window.partitionBy("click_date", "province").orderBy(F.col("click_count").desc(), F.col("ad_id"))
    return (
        daily_counts.withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= int(n))
        .select("click_date", "province", "ad_id", "click_count")
    )


def blacklist_candidates(user_counts: DataFrame, threshold: int = 100) -> DataFrame:
    """Distinct users with at least ``threshold`` clicks on one ad on one day."""
    return user_counts.where(F.col("click_count") >= int(threshold)).select("user_id").distinct()


def ad_minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per ``(click_date, ad_id, minute)``; ``minute`` is the minute's start (UTC).

    The minute is a tumbling ``window(ts, '1 minute')``, an event-time key: on a watermarked
    stream the state of closed minutes is dropped."""
    clicks = clicks.where(all_not_null("click_date", "ad_id", "ts"))
    return (
        clicks.groupBy("click_date", "ad_id", F.window("ts", "1 minute").alias("mw"))
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select("click_date", "ad_id", as_wall_time(F.col("mw.start")).alias("minute"), "click_count")
    )


def _trend_by_minute_deltas(clicks: DataFrame, window_minutes: int):
    """Sliding counts as a running sum of enter/leave deltas, without array lambdas.

    Each minute row ``m`` (count ``n``) emits from one ``explode``: ``+n`` at end ``m+1`` (it
    enters the windows), ``-n`` at end ``m+window+1`` (it leaves them), and the window ends
    ``m+1 ..`` up to the next minute with clicks (or ``m+window``).  A running sum ordered by end,
    deltas before ends, is each end's count.  Both windows are partitioned by (date, ad), at most
    1440 minute rows, so the second adds a sort but no shuffle."""
    per_minute = clicks.groupBy(
        "click_date", "ad_id", F.floor(F.unix_seconds(minute_of(F.col("ts"))) / 60).cast("long").alias("mi")
    ).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("click_date", "ad_id")
    last_end = F.least(
        F.col("mi") + window_minutes,
        F.coalesce(F.lead("mi").over(group.orderBy("mi")), F.col("mi") + window_minutes),
    )
    # j = -2: the minute leaves the windows; j = -1: it enters them; j >= 0: end m + 1 + j
    spread = per_minute.withColumn("last_end", last_end).select(
        "click_date", "ad_id", "mi", "n",
        F.explode(F.sequence(F.lit(-2).cast("long"), F.col("last_end") - F.col("mi") - 1)).alias("j"),
    )
    j = F.col("j")
    events = spread.select(
        "click_date",
        "ad_id",
        F.when(j == -2, F.col("mi") + window_minutes + 1).when(j == -1, F.col("mi") + 1)
        .otherwise(F.col("mi") + 1 + j).alias("pos"),
        F.when(j < 0, 0).otherwise(1).alias("is_end"),
        F.when(j == -2, -F.col("n")).when(j == -1, F.col("n")).otherwise(0).alias("delta"),
    )
    running = F.sum("delta").over(
        group.orderBy("pos", "is_end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = (
        events.select("click_date", "ad_id", "pos", "is_end", running.alias("click_count"))
        .where(F.col("is_end") == 1)
        .select("click_date", "ad_id", F.timestamp_seconds(F.col("pos") * 60).alias("w_end"), "click_count")
    )
    return counted, as_wall_time(F.col("w_end"))


def ad_trend(clicks: DataFrame, window_minutes: int = 60, method: str = "minute_deltas") -> DataFrame:
    """Per ``(click_date, ad_id, window_end)``: clicks in ``[window_end - window, window_end)``,
    for every minute end whose window holds a click; ``minute`` is ``window_end``'s minute of
    the hour.  The date is the click's date, so a window across midnight gives a row per date.

    All methods give the same rows:

    * ``minute_deltas`` (batch default): clicks per minute, then per (date, ad) (at most 1440
      minute rows, so bounded under any skew) a running sum of enter/leave deltas emits every
      window end once; only minute counts cross the network, no re-aggregation, no lambdas.
    * ``window``: Spark's sliding ``window(ts, '60 minutes', '1 minute')`` on raw clicks (the
      form a streaming aggregation can use in ``update`` mode).
    * ``window_chain``: one-minute windows, then the sliding window over their ``window_time``:
      two chained event-time aggregations, which a stream runs in ``append`` mode with a
      watermark (each window is written once, when the watermark closes it)."""
    clicks = clicks.where(all_not_null("click_date", "ad_id", "ts"))
    if method == "window":
        win = F.window("ts", f"{window_minutes} minutes", "1 minute")
        counted = clicks.groupBy("click_date", "ad_id", win.alias("w")).agg(F.count(F.lit(1)).alias("click_count"))
        end = as_wall_time(F.col("w.end"))
    elif method == "window_chain":
        per_minute = clicks.groupBy(F.window("ts", "1 minute").alias("mw"), "click_date", "ad_id").agg(
            F.count(F.lit(1)).alias("n")
        )
        win = F.window(F.window_time("mw"), f"{window_minutes} minutes", "1 minute")
        counted = per_minute.groupBy(win.alias("w"), "click_date", "ad_id").agg(F.sum("n").alias("click_count"))
        end = as_wall_time(F.col("w.end"))
    elif method == "minute_deltas":
        counted, end = _trend_by_minute_deltas(clicks, int(window_minutes))
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.select(
        "click_date",
        "ad_id",
        end.alias("window_end"),
        F.date_format(end, "mm").alias("minute"),
        F.col("click_count").cast("long").alias("click_count"),
    )
