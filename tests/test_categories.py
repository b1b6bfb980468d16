from pyspark.sql import functions as F

from conftest import ts, visit, visits_df
from visitflow.operators import (
    category_click_events, category_counts, session_detail, top_categories, top_sessions_per_category,
)
from visitflow.schemas import DETAIL_COLUMNS


def _clicks(session, cat, n, start_minute=0):
    return [visit(session, f"2019-01-14 01:{start_minute + i:02d}:00", action="click", click=cat) for i in range(n)]


def _orders(session, cat, n):
    return [visit(session, f"2019-01-14 02:{i:02d}:00", action="order", order=cat) for i in range(n)]


def _pays(session, cat, n, action="pay"):
    return [visit(session, f"2019-01-14 03:{i:02d}:00", action=action, pay=cat) for i in range(n)]


def test_category_counts_rules(spark):
    rows = (_clicks("s", 5, 3) + _orders("s", 5, 2) + _pays("s", 5, 1)
            + _clicks("s", 6, 4) + _orders("s", 6, 1)                  # no payment: dropped
            + _clicks("s", 0, 2) + _orders("s", 0, 2)                  # category 0: no pay possible
            + _clicks("s", 7, 1) + _orders("s", 7, 1) + _pays("s", 7, 2, action="search"))  # pay ignores action
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count)
           for r in category_counts(visits_df(spark, rows)).collect()}
    assert got == {5: (3, 2, 1), 7: (1, 1, 2)}
    strict = {r.category_id for r in category_counts(visits_df(spark, rows), pay_requires_action=True).collect()}
    assert strict == {5}


def test_top_categories_tie_breaks(spark):
    counts = spark.createDataFrame(
        [(1, 10, 1, 1), (2, 10, 2, 1), (3, 10, 2, 5), (4, 10, 2, 5), (5, 9, 9, 9), (6, 11, 0, 0)],
        "category_id long, click_count long, order_count long, pay_count long",
    )
    got = [r.category_id for r in top_categories(counts, n=5).orderBy(
        *[F.col(c).desc() for c in ("click_count", "order_count", "pay_count")],
        "category_id").collect()]
    assert got == [6, 3, 4, 2, 1]
    assert top_categories(counts, n=5).columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]


def test_click_events_and_top_sessions(spark):
    rows = (_clicks("s1", 5, 3) + _clicks("s2", 5, 1, start_minute=10) + _orders("s1", 5, 1) + _pays("s1", 5, 1)
            + [visit("s1", "2019-01-14 04:00:00", action="search", keyword="cake", page_id=4)]
            + _clicks("s3", 8, 1, start_minute=20) + _orders("s3", 8, 1))  # category 8 has no pay: not top
    visits = visits_df(spark, rows)
    top = top_categories(category_counts(visits))
    events = category_click_events(visits, top)
    got = sorted(tuple(r) for r in events.collect())
    assert got == [(1, 5, "s1", 4)] * 3 + [(1, 5, "s2", 4)]
    per_session = sorted(tuple(r) for r in top_sessions_per_category(visits, top).collect())
    assert per_session == [(1, 5, "s1", 3), (1, 5, "s2", 1)]
    detail = session_detail(visits, events)
    assert detail.columns == DETAIL_COLUMNS
    detail_rows = detail.collect()
    assert sorted({r.session_id for r in detail_rows}) == ["s1", "s2"]
    assert len([r for r in detail_rows if r.session_id == "s1"]) == 6
    search = [r for r in detail_rows if r.search_keyword == "cake"][0]
    assert (search.page_id, search.action_time) == (4, ts("2019-01-14 04:00:00"))


def test_top_sessions_limit_and_ties(spark):
    rows = []
    for i in range(15):
        rows += _clicks(f"s{i:02d}", 5, 1 + (i % 3))
    rows += _orders("s00", 5, 1) + _pays("s00", 5, 1)
    visits = visits_df(spark, rows, partitions=4)
    got = top_sessions_per_category(visits, top_categories(category_counts(visits))).collect()
    assert len(got) == 10
    # counts 3 for i%3==2 (5 sessions), 2 for i%3==1 (5 sessions): the ten largest, ties by id
    assert sorted(r.session_id for r in got) == sorted(f"s{i:02d}" for i in range(15) if i % 3 != 0)


def test_empty_input_gives_empty_outputs(spark):
    visits = visits_df(spark, [])
    top = top_categories(category_counts(visits))
    assert top.count() == 0
    assert category_click_events(visits, top).count() == 0
    assert session_detail(visits, category_click_events(visits, top)).count() == 0
