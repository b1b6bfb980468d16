import datetime as dt
import math

from conftest import ts, users_df, visit, visits_df
from visitflow.operators import (
    sample_sessions, session_histogram, session_histogram_share, session_summary, visits_in_range,
)


def test_visits_in_range_half_open_semi_join(spark):
    rows = [
        visit("a", "2019-01-14 01:00:00", user_id=1),
        visit("a", "2019-01-14 04:59:59", user_id=1),
        visit("a", "2019-01-14 05:00:00", user_id=1),
        visit("b", "2019-01-14 02:00:00", user_id=7),   # user 7 is unknown
        visit("c", "2019-01-14 03:00:00", user_id=2),   # user 2 is listed twice
    ]
    got = visits_in_range(visits_df(spark, rows), users_df(spark, [1, 2, 2]), "2019-01-14 01:00:00", "2019-01-14 05:00:00")
    times = sorted((r.session_id, r.action_time) for r in got.collect())
    assert times == [("a", ts("2019-01-14 01:00:00")), ("a", ts("2019-01-14 04:59:59")), ("c", ts("2019-01-14 03:00:00"))]
    assert got.columns == visits_df(spark, rows).columns


def test_session_summary_drops_single_page_and_merges_partitions(spark):
    rows = [visit("one_page", f"2019-01-14 01:0{i}:00", page_id=3) for i in range(5)]
    # a session spread over many partitions: true min and max survive the merge
    rows += [visit("spread", f"2019-01-14 02:{m:02d}:00", page_id=m % 4) for m in range(40)]
    # a session across noon: 24-hour clock
    rows += [visit("noon", "2019-01-14 11:50:00", page_id=1), visit("noon", "2019-01-14 12:10:00", page_id=2),
             visit("noon", "2019-01-14 13:05:00", page_id=3)]
    got = {r.session_id: r for r in session_summary(visits_df(spark, rows, partitions=7)).collect()}
    assert set(got) == {"spread", "noon"}
    assert got["spread"].start_time == ts("2019-01-14 02:00:00")
    assert got["spread"].end_time == ts("2019-01-14 02:39:00")
    assert got["spread"].page_count == 4
    assert (got["noon"].start_time, got["noon"].end_time, got["noon"].page_count) == (
        ts("2019-01-14 11:50:00"), ts("2019-01-14 13:05:00"), 3)


def _summary_rows(spark, spec):
    """spec: (session, duration seconds, pages)"""
    return spark.createDataFrame(
        [(sid, ts("2019-01-14 01:00:00"), ts("2019-01-14 01:00:00") + dt.timedelta(seconds=d), p)
         for sid, d, p in spec],
        "session_id string, start_time timestamp_ntz, end_time timestamp_ntz, page_count long",
    )


def test_histogram_counts_every_label(spark):
    spec = [("s0", 0, 2), ("s1", 29, 3), ("s2", 30, 4), ("s3", 59, 6), ("s4", 60, 7), ("s5", 179, 10),
            ("s6", 180, 11), ("s7", 599, 2), ("s8", 600, 3)]
    got = dict(tuple(r) for r in session_histogram(_summary_rows(spark, spec)).collect())
    assert got == {"0s-30S": 2, "30s-60s": 2, "1m-3m": 2, "3m-10m": 2, "10m": 1,
                   "0-4": 4, "4-7": 2, "7-10": 2, "other": 1, "sessionCount": 9}


def test_histogram_of_empty_input_is_zero(spark):
    got = dict(tuple(r) for r in session_histogram(_summary_rows(spark, [])).collect())
    assert got == {k: 0 for k in ["0s-30S", "30s-60s", "1m-3m", "3m-10m", "10m", "0-4", "4-7", "7-10", "sessionCount"]}
    share = {r.bucket: r.share for r in session_histogram_share(_summary_rows(spark, [])).collect()}
    assert len(share) == 8 and all(v is None for v in share.values())


def test_histogram_share(spark):
    spec = [("s0", 10, 2), ("s1", 700, 5), ("s2", 800, 5), ("s3", 900, 8)]
    got = {r.bucket: (r.session_count, r.share) for r in session_histogram_share(_summary_rows(spark, spec)).collect()}
    assert got["10m"] == (3, 0.75)
    assert got["4-7"] == (2, 0.5)
    assert got["30s-60s"] == (0, 0.0)
    assert "sessionCount" not in got and "other" not in got


def _sessions_over_hours(spark, counts):
    """counts: sessions per hour, hours 01, 02, ..."""
    rows = []
    for h, n in enumerate(counts, start=1):
        for i in range(n):
            start = ts(f"2019-01-14 {h:02d}:{i % 60:02d}:00")
            rows.append((f"h{h}-s{i}", start, start, 2))
    return spark.createDataFrame(rows, "session_id string, start_time timestamp_ntz, end_time timestamp_ntz, page_count long")


def test_sample_never_exceeds_group_and_keeps_quota(spark):
    small = _sessions_over_hours(spark, [2, 3, 5])  # 10 sessions, fewer than n=30
    got = sample_sessions(small, n=30, seed=42).collect()
    assert len(got) == 10 and len({r.session_id for r in got}) == 10

    big = _sessions_over_hours(spark, [10, 20, 30, 40])  # 100 sessions over 4 hours
    got = sample_sessions(big, n=30, seed=42).collect()
    per_hour = {}
    for r in got:
        per_hour[r.start_time.hour] = per_hour.get(r.start_time.hour, 0) + 1
    assert per_hour == {h: math.ceil(30 * n / 100) for h, n in zip([1, 2, 3, 4], [10, 20, 30, 40])}
    assert {r.task_id for r in got} == {1}


def test_sample_is_deterministic_and_seeded(spark):
    big = _sessions_over_hours(spark, [10, 20, 30, 40])
    a = sorted(r.session_id for r in sample_sessions(big, n=30, seed=7).collect())
    b = sorted(r.session_id for r in sample_sessions(big.repartition(5), n=30, seed=7).collect())
    c = sorted(r.session_id for r in sample_sessions(big, n=30, seed=8).collect())
    assert a == b
    assert a != c


def test_sample_matches_brute_force(spark):
    import hashlib

    big = _sessions_over_hours(spark, [7, 13, 1, 29])
    rows = big.collect()
    total = len(rows)
    expected = set()
    for hour in {r.start_time.hour for r in rows}:
        group = sorted((hashlib.md5(f"5:{r.session_id}".encode()).hexdigest(), r.session_id)
                       for r in rows if r.start_time.hour == hour)
        quota = min(len(group), -(-30 * len(group) // total))
        expected |= {sid for _, sid in group[:quota]}
    got = {r.session_id for r in sample_sessions(big, n=30, seed=5).collect()}
    assert got == expected


def test_minute_bounds_include_the_start_minute(spark):
    # the reference compared "yyyy-MM-dd HH:mm:ss" strings with "yyyy-MM-dd HH:mm" bounds, so
    # 01:00:00 was inside and 05:00:00 outside: the same as [start, end) on timestamps
    rows = [visit("a", "2019-01-14 01:00:00"), visit("a", "2019-01-14 00:59:59"), visit("a", "2019-01-14 05:00:00")]
    got = visits_in_range(visits_df(spark, rows), users_df(spark, [1]), "2019-01-14 01:00", "2019-01-14 05:00").collect()
    assert [r.action_time for r in got] == [ts("2019-01-14 01:00:00")]


def test_summary_of_visits_from_events_adapter(spark):
    from visitflow.sources import visits_from_events

    events = spark.createDataFrame(
        [(1, ts("2024-01-05 00:59:59.9"), 3, "click", 1.0, '{"k": 12}'),
         (2, ts("2024-01-05 01:00:00.5"), 3, "purchase", 1.0, '{"k": 7}'),
         (3, ts("2024-01-05 02:00:00"), 3, "view", 1.0, '{"k": 8}'),
         (4, ts("2024-01-05 03:00:00"), 3, "signup", 1.0, 'not json')],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    rows = visits_from_events(events, "2024-01-05 01:00:00", "2024-01-05 04:00:00").orderBy("action_time").collect()
    assert [r.action for r in rows] == ["pay", "search", "order"]
    assert rows[0].action_time == ts("2024-01-05 01:00:00")
    assert (rows[0].pay_category_id, rows[0].pay_product_id, rows[0].page_id) == (7, 2, 7)
    assert (rows[1].search_keyword, rows[1].page_id) == ("view", 8)
    assert rows[2].order_category_id is None and rows[2].session_id == "3-2024-01-05"


def test_sample_of_no_sessions_is_empty(spark):
    assert sample_sessions(_sessions_over_hours(spark, []), n=30, seed=1).count() == 0
