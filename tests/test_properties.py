"""Random small inputs against plain-Python brute force."""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import visits_df
from visitflow.operators import (
    ad_trend, category_counts, daily_ad_counts, province_top_ads, session_histogram, session_summary,
)
from visitflow.sources import with_click_time

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.datetime(2024, 1, 1)

visit_rows = st.lists(
    st.tuples(
        st.sampled_from(["s1", "s2", "s3", "s4"]),
        st.integers(0, 7200),                       # seconds after BASE
        st.integers(0, 13),                         # page
        st.sampled_from(["click", "order", "pay", "search"]),
        st.integers(0, 4),                          # category
    ),
    max_size=60,
)


def _visits(spark, rows):
    out = []
    for sid, sec, page, action, cat in rows:
        t = BASE + dt.timedelta(seconds=sec)
        out.append((t.date(), 1, sid, t, action,
                    cat if action == "pay" else 0, 0,
                    cat if action == "click" else 0, 0,
                    cat if action == "order" else 0, 0, "", page))
    return visits_df(spark, out, partitions=3)


@SETTINGS
@given(rows=visit_rows)
def test_summary_and_histogram_match_brute_force(spark, rows):
    by_session = collections.defaultdict(list)
    for sid, sec, page, *_ in rows:
        by_session[sid].append((sec, page))
    expected = {}
    for sid, items in by_session.items():
        pages = len({p for _, p in items})
        if pages != 1:
            expected[sid] = (min(s for s, _ in items), max(s for s, _ in items), pages)
    summary = session_summary(_visits(spark, rows))
    got = {r.session_id: (int((r.start_time - BASE).total_seconds()), int((r.end_time - BASE).total_seconds()), r.page_count)
           for r in summary.collect()}
    assert got == expected

    def dur(s):
        return "0s-30S" if s < 30 else "30s-60s" if s < 60 else "1m-3m" if s < 180 else "3m-10m" if s < 600 else "10m"

    def pg(n):
        return "0-4" if n < 4 else "4-7" if n < 7 else "7-10" if n <= 10 else "other"

    counts = collections.Counter()
    for lo, hi, pages in expected.values():
        counts[dur(hi - lo)] += 1
        counts[pg(pages)] += 1
    hist = dict(tuple(r) for r in session_histogram(summary).collect())
    for label in ["0s-30S", "30s-60s", "1m-3m", "3m-10m", "10m", "0-4", "4-7", "7-10"]:
        assert hist[label] == counts[label]
    assert hist["sessionCount"] == len(expected)
    assert hist.get("other", 0) == counts["other"]
    assert ("other" in hist) == (counts["other"] > 0)


@SETTINGS
@given(rows=visit_rows)
def test_category_counts_match_brute_force(spark, rows):
    c = collections.defaultdict(lambda: [0, 0, 0])
    for _, _, _, action, cat in rows:
        if action == "click":
            c[cat][0] += 1
        elif action == "order":
            c[cat][1] += 1
        elif action == "pay" and cat != 0:
            c[cat][2] += 1
    expected = {k: tuple(v) for k, v in c.items() if all(v)}
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count)
           for r in category_counts(_visits(spark, rows)).collect()}
    assert got == expected


click_rows = st.lists(
    st.tuples(st.sampled_from(["P", "Q"]), st.integers(0, 6), st.integers(0, 3 * 86400 - 1)),
    max_size=50,
)


def _clicks(spark, rows):
    data = [(p, "c", 1, ad, int((BASE + dt.timedelta(seconds=s)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
            for p, ad, s in rows]
    df = spark.createDataFrame(data, "province string, city string, user_id long, ad_id long, ts_ms long")
    return with_click_time(df.repartition(3))


@SETTINGS
@given(rows=click_rows)
def test_province_top_ads_match_brute_force(spark, rows):
    counts = collections.Counter(((BASE + dt.timedelta(seconds=s)).date(), p, ad) for p, ad, s in rows)
    groups = collections.defaultdict(list)
    for (day, p, ad), n in counts.items():
        groups[(day, p)].append((-n, ad))
    expected = sorted((day, p, ad, -negn) for (day, p), items in groups.items() for negn, ad in sorted(items)[:3])
    got = sorted(tuple(r) for r in province_top_ads(daily_ad_counts(_clicks(spark, rows))).collect())
    assert got == expected


@SETTINGS
@given(rows=click_rows)
def test_ad_trend_matches_brute_force(spark, rows):
    expected = collections.Counter()
    for _, ad, s in rows:
        t = BASE + dt.timedelta(seconds=s)
        minute = t.replace(second=0)
        for i in range(1, 61):                      # windows [end - 60 min, end) holding t
            expected[(t.date(), ad, minute + dt.timedelta(minutes=i))] += 1
    got = {(r.click_date, r.ad_id, r.window_end): r.click_count for r in ad_trend(_clicks(spark, rows)).collect()}
    assert got == dict(expected)


@SETTINGS
@given(rows=visit_rows, n_sessions=st.integers(1, 3), n=st.integers(1, 4))
def test_category_sessions_match_brute_force(spark, rows, n_sessions, n):
    from visitflow.operators import category_click_events, session_detail, top_categories, top_sessions_per_category

    c = collections.defaultdict(lambda: [0, 0, 0])
    for _, _, _, action, cat in rows:
        if action == "click":
            c[cat][0] += 1
        elif action == "order":
            c[cat][1] += 1
        elif action == "pay" and cat != 0:
            c[cat][2] += 1
    ranked = sorted(((-v[0], -v[1], -v[2], k) for k, v in c.items() if all(v)))[:n]
    top = {k: -clicks for clicks, _, _, k in ranked}
    clicks = [(sid, cat) for sid, _, _, action, cat in rows if action == "click" and cat != 0 and cat in top]

    visits = _visits(spark, rows)
    top_df = top_categories(category_counts(visits), n=n)
    events = sorted((r.category_id, r.session_id, r.click_count) for r in category_click_events(visits, top_df).collect())
    assert events == sorted((cat, sid, top[cat]) for sid, cat in clicks)

    per = collections.Counter(clicks)
    expected_top = []
    for cat in top:
        sessions = sorted(((-cnt, sid) for (sid, cc), cnt in per.items() if cc == cat))[:n_sessions]
        expected_top += [(cat, sid, -negc) for negc, sid in sessions]
    got_top = sorted((r.category_id, r.session_id, r.click_count)
                     for r in top_sessions_per_category(visits, top_df, n_sessions=n_sessions).collect())
    assert got_top == sorted(expected_top)

    chosen = {sid for sid, _ in clicks}
    detail = session_detail(visits, category_click_events(visits, top_df)).collect()
    assert len(detail) == sum(1 for r in rows if r[0] in chosen)


@SETTINGS
@given(
    sessions=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 59)), min_size=0, max_size=80),
    n=st.integers(1, 40),
    seed=st.integers(0, 1000),
)
def test_sample_matches_brute_force(spark, sessions, n, seed):
    import hashlib
    import math

    from visitflow.operators import sample_sessions

    rows = [(f"s{i}", BASE + dt.timedelta(hours=h, minutes=m)) for i, (h, m) in enumerate(sessions)]
    df = spark.createDataFrame(
        [(sid, t, t, 2) for sid, t in rows],
        "session_id string, start_time timestamp_ntz, end_time timestamp_ntz, page_count long",
    ).repartition(3)
    total = len(rows)
    expected = set()
    for hour in {t.hour for _, t in rows}:
        group = sorted((hashlib.md5(f"{seed}:{sid}".encode()).hexdigest(), sid) for sid, t in rows if t.hour == hour)
        quota = min(len(group), math.ceil(n * len(group) / total))
        expected |= {sid for _, sid in group[:quota]}
    assert {r.session_id for r in sample_sessions(df, n=n, seed=seed).collect()} == expected
