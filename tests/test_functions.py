from pyspark.sql import functions as F

from visitflow.functions import duration_bucket, page_bucket, seconds_between
from visitflow.functions.timecols import hour_of


def test_duration_bucket_edges(spark):
    secs = [0, 29, 30, 59, 60, 179, 180, 599, 600, -5, None]
    df = spark.createDataFrame([(s,) for s in secs], "s long")
    got = [r[0] for r in df.select(duration_bucket(F.col("s"))).collect()]
    assert got == ["0s-30S", "0s-30S", "30s-60s", "30s-60s", "1m-3m", "1m-3m", "3m-10m", "3m-10m",
                   "10m", "0s-30S", None]


def test_page_bucket_edges(spark):
    pages = [2, 3, 4, 6, 7, 10, 11, None]
    df = spark.createDataFrame([(p,) for p in pages], "p long")
    got = [r[0] for r in df.select(page_bucket(F.col("p"))).collect()]
    assert got == ["0-4", "0-4", "4-7", "4-7", "7-10", "7-10", "other", None]


def test_seconds_between_truncates_and_uses_24h_clock(spark):
    df = spark.createDataFrame(
        [("2018-12-21 03:02:40", "2018-12-21 03:59:25"), ("2018-12-21 11:30:00", "2018-12-21 13:30:00")],
        "a string, b string",
    ).select(F.to_timestamp_ntz("a").alias("a"), F.to_timestamp_ntz("b").alias("b"))
    rows = df.select(
        seconds_between(F.col("a"), F.col("b")).alias("s"),
        duration_bucket(seconds_between(F.col("a"), F.col("b"))).alias("bucket"),
        hour_of(F.col("b")).cast("string").alias("hour"),
    ).collect()
    assert (rows[0].s, rows[0].bucket) == (3405, "10m")
    assert rows[1].s == 7200  # across noon: a 12-hour clock would lose 12 hours here
    assert rows[1].hour == "2018-12-21 13:00:00"
