"""The join on the session id and the three-column order, through the operators that use them."""

from conftest import visit, visits_df

from visitflow.operators import session_detail, top_categories


def test_detail_joins_on_the_session_id(spark):
    visits = visits_df(spark, [
        visit("s-red", "2021-06-01 08:00:00", page_id=4), visit("s-blue", "2021-06-01 08:05:00", page_id=2),
        visit("s-red", "2021-06-01 08:09:00", page_id=7)])
    selected = spark.createDataFrame([("s-red",), ("s-red",), ("s-none",)], "session_id string")
    assert sorted((r.session_id, r.page_id) for r in session_detail(visits, selected).collect()) == [("s-red", 4), ("s-red", 7)]


def test_top_categories_order_by_three_counts(spark):
    counts = spark.createDataFrame(
        [(1, 9, 4, 4), (2, 9, 5, 1), (3, 8, 9, 9), (4, 9, 4, 6), (5, 9, 4, 4)],
        "category_id long, click_count long, order_count long, pay_count long")
    assert [r.category_id for r in top_categories(counts, 4).collect()] == [2, 4, 1, 5]
