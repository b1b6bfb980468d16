"""Session parts by day, SQL functions, tables by user, and the threshold top-k."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import users_df, visit, visits_df
from visitflow.functions.buckets import duration_bucket, page_bucket
from visitflow.functions.sql import register_functions, session_buckets_sql, session_summary_sql, visits_in_range_sql
from visitflow.operators import ads, category_counts, session_summary, top_categories, visits_in_range
from visitflow.operators.partials import merged_summary, session_parts, summary_of_range, write_session_parts
from visitflow.operators.topk import partial_sums, threshold_candidates, threshold_top_categories, threshold_top_k
from visitflow.plans import TableCounts
from visitflow.sources import adapters, load_driver_clicks
from visitflow.sources.by_user import counts_by_user, hot_part, rows_of_others, rows_of_users, save_by_user

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def _random_visits(seed, n=1500):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.randrange(6 * 86_400))
        row = list(visit(f"s{r.randrange(80)}", str(at), page_id=r.choice([0, 1, 2, 40_000, -5, 32_768, 10**9]), user_id=r.randrange(30)))
        if r.random() < 0.02:
            row[2 if r.random() < 0.5 else 12] = None  # no session, or no page
        rows.append(tuple(row))
    return rows


def test_parts_of_days_give_the_summary_of_any_range(spark, scratch_dir):
    visits = visits_df(spark, _random_visits(1), partitions=4).cache()
    path = f"{scratch_dir}/parts"
    write_session_parts(visits, path)
    write_session_parts(visits.where("action_time < '2024-01-02 12:00:00'").where("action_time >= '2024-01-01'").limit(0), path)  # no day: nothing changes
    r = random.Random(2)
    ranges = [("2024-01-01 00:00:00", "2024-01-07 00:00:00"), ("2024-01-02 00:00:00", "2024-01-02 00:00:00"), ("2024-01-02 08:00:00", "2024-01-02 09:30:00"),
              ("2024-01-02 00:00:00", "2024-01-03 00:00:00"), ("2024-01-02 23:59:59", "2024-01-04 00:00:01")]
    ranges += [tuple(str(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)) for s in sorted(r.sample(range(6 * 86_400), 2))) for _ in range(3)]
    for start, end in ranges:
        want = session_summary(visits.where(f"action_time >= '{start}' and action_time < '{end}'"))
        assert _rows(summary_of_range(spark, path, visits, start, end)) == _rows(want), (start, end)


def test_parts_are_small_and_merge_in_any_order(spark):
    visits = visits_df(spark, _random_visits(3, 400)).cache()
    parts = session_parts(visits)
    assert parts.agg(F.max(F.octet_length("pages"))).collect()[0][0] <= 4096
    assert parts.where("page_range = 1 and octet_length(pages) = 1").count() > 0  # page 1 or 2: one byte
    halves = session_parts(visits.where("user_id < 15")).unionByName(session_parts(visits.where("user_id >= 15")))
    assert _rows(merged_summary(halves)) == _rows(merged_summary(parts)) == _rows(session_summary(visits))


def test_a_rewritten_day_replaces_its_parts(spark, scratch_dir):
    path = f"{scratch_dir}/parts"
    one = visits_df(spark, _random_visits(4, 300)).cache()
    write_session_parts(one, path)
    day = one.where("action_time >= '2024-01-03' and action_time < '2024-01-04'").where("user_id < 10")
    write_session_parts(day, path)
    want = session_summary(one.where("action_time < '2024-01-03' or action_time >= '2024-01-04'").unionByName(day))
    assert _rows(summary_of_range(spark, path, one, "2024-01-01 00:00:00", "2024-01-07 00:00:00")) == _rows(want)


def test_whole_days_read_no_visits(spark, scratch_dir, capsys):
    one = visits_df(spark, _random_visits(5, 200))
    one.write.parquet(f"{scratch_dir}/visits")
    write_session_parts(one, f"{scratch_dir}/parts")
    visits = spark.read.parquet(f"{scratch_dir}/visits")
    summary_of_range(spark, f"{scratch_dir}/parts", visits, "2024-01-02 06:00:00", "2024-01-05 00:00:00").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "action_date" in plan and "GreaterThanOrEqual(action_time" in plan


def test_sql_form_equals_the_dataframe_form(spark):
    visits, users = visits_df(spark, _random_visits(6, 300)), users_df(spark, range(0, 30, 2))
    start, end = "2024-01-02 00:00:00", "2024-01-04 12:00:00"
    by_sql = visits_in_range_sql(spark, dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end), visits, users)
    by_frame = visits_in_range(visits, users, start, end)
    assert by_sql.columns == by_frame.columns and _rows(by_sql) == _rows(by_frame) and by_sql.count() > 20
    assert _rows(session_summary_sql(spark, by_sql)) == _rows(session_summary(by_frame))
    nodes = lambda df: [line.strip(" +-:").split(" ")[0] for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert nodes(session_summary_sql(spark, visits)) == nodes(session_summary(visits))


def test_sql_functions_are_inlined(spark):
    assert set(register_functions(spark)) >= {"duration_bucket", "page_bucket", "seconds_between", "hour_bucket", "click_day"}
    df = spark.createDataFrame([(s,) for s in [None, -5, 0, 29, 30, 59, 60, 179, 180, 599, 600, 10**9, 3, 4, 7, 10, 11]], "n long")
    named = df.selectExpr("duration_bucket(n) AS d", "page_bucket(n) AS p")
    built = df.select(duration_bucket(F.col("n")).alias("d"), page_bucket(F.col("n")).alias("p"))
    assert _rows(named) == _rows(built) and len({r.d for r in named.collect()}) == 6
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert "duration_bucket" not in plan and "CASE WHEN" in plan
    [row] = spark.sql("SELECT hour_bucket(timestamp_ntz'2024-01-02 13:59:59') AS h, click_day(1704067199999) AS d, "
                      "seconds_between(timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 00:01:30') AS s").collect()
    assert (str(row.h), str(row.d), row.s) == ("2024-01-02 13:00:00", "2023-12-31", 90)


def test_buckets_of_both_kinds_by_sql(spark):
    summary = session_summary(visits_df(spark, _random_visits(7)))
    got = {(r.duration, r.pages): r.session_count for r in session_buckets_sql(spark, summary).collect()}
    assert sum(got.values()) == summary.count() and all(k[0] and k[1] for k in got)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in old.items():
        spark.conf.set(n, v) if v else spark.conf.unset(n)


def _plan(df, capsys):
    df.collect()
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_tables_by_user_join_and_count_without_a_shuffle(spark, no_broadcast, capsys):
    rows = [("P", "C", 0 if k % 3 == 0 else k % 400, k % 20, k % 5) for k in range(12_000)] + [("P", "C", None, 1, 1)] * 5
    clicks = spark.createDataFrame(rows, "province string, city string, user_id long, ad_id long, click_date long")
    listed = spark.createDataFrame([(u,) for u in [*range(0, 500, 7), 3, 3, None]], "user_id long")
    for name in ("by_user_clicks", "by_user_listed"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_hot")
    save_by_user(clicks, "by_user_clicks", 8)
    save_by_user(listed, "by_user_listed", 8)
    assert [r[0] for r in hot_part(spark, "by_user_clicks").select("user_id").distinct().collect()] == [0]
    assert hot_part(spark, "by_user_clicks").rdd.getNumPartitions() > 1  # the hot user stays split
    known = clicks.where("user_id is not null")
    keys = listed.where("user_id is not null")
    for got, how in ((rows_of_users(spark, "by_user_clicks", "by_user_listed"), "left_semi"), (rows_of_others(spark, "by_user_clicks", "by_user_listed"), "left_anti")):
        assert _rows(got) == _rows(known.join(keys, "user_id", how).select(*clicks.columns))
    got = counts_by_user(spark, "by_user_clicks", ["click_date", "user_id", "ad_id"])
    assert _rows(got) == _rows(ads.user_ad_counts(clicks))
    # buckets meet buckets: nothing but the few keys of hot users moves
    plan = _plan(rows_of_users(spark, "by_user_clicks", "by_user_listed"), capsys)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    below = plan[plan.index("SortMergeJoin"):plan.index("BroadcastHashJoin", plan.index("SortMergeJoin"))]
    assert "Exchange" not in below, plan
    alone = spark.table("by_user_clicks").where("user_id is not null").groupBy("click_date", "user_id", "ad_id").count()
    assert "Exchange" not in _plan(alone, capsys)


def test_tables_without_hot_users(spark):
    df = spark.range(1000).selectExpr("id as user_id", "id % 7 as v")
    for name in ("by_user_plain", "by_user_empty"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_hot")
    save_by_user(df, "by_user_plain", 4)
    save_by_user(df.limit(0), "by_user_empty", 4)
    assert _rows(rows_of_users(spark, "by_user_plain", "by_user_plain")) == _rows(df)
    assert rows_of_users(spark, "by_user_plain", "by_user_empty").count() == 0
    assert _rows(rows_of_others(spark, "by_user_plain", "by_user_empty")) == _rows(df)
    assert counts_by_user(spark, "by_user_empty", ["user_id"]).count() == 0


def test_threshold_top_k_under_ties_and_skew(spark):
    r = random.Random(8)
    for trial in range(3):
        weights = [int(2 ** r.uniform(0, 9)) for _ in range(300)] if trial else [5] * 300  # all tie
        rows = [(f"k{k}" if k else None, 1) for k, w in enumerate(weights) for _ in range(w)]
        r.shuffle(rows)
        df = spark.createDataFrame(rows, "key string, n long").repartition(1 + 3 * trial)
        partials = partial_sums(df, ["key"], ["n"]).cache()
        for k in (7, 1000):
            want = df.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "key").limit(k)
            assert [tuple(x) for x in threshold_top_k(partials, ["key"], "n", k).collect()] == [tuple(x) for x in want.collect()]
        partials.unpersist()
    empty = partial_sums(spark.createDataFrame([], "key string, n long"), ["key"], ["n"])
    assert threshold_top_k(empty, ["key"], "n", 5).count() == 0


def test_threshold_top_k_leaves_most_keys_where_they_are(spark):
    """A million keys, few of them frequent: few partial sums are read by the rounds that shuffle."""
    frequent = F.floor(F.pow(F.rand(5), 6) * 200).cast("long")
    df = spark.range(0, 1_600_000, 1, 8).select(F.when(F.col("id") % 4 == 0, frequent).otherwise(F.col("id") % 1_000_000 + 1000).alias("key"), F.lit(1).cast("long").alias("n"))
    partials = partial_sums(df, ["key"], ["n"]).checkpoint(eager=True)
    total = partials.count()
    assert partials.select("key").distinct().count() > 700_000
    counts = TableCounts()
    got = threshold_top_k(partials, ["key"], "n", 10, counts).collect()
    want = df.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "key").limit(10).collect()
    assert [tuple(x) for x in got] == [tuple(x) for x in want]
    shuffled = sum(counts.get(f"round {k}")["rows"] for k in (1, 2, 3))
    print(f"threshold top-k: {shuffled} of {total} partial sums shuffled")
    assert shuffled < total / 100


def test_candidates_hold_all_that_tie(spark):
    df = spark.createDataFrame([(k, 10 if k < 8 else 1) for k in range(50)], "key long, n long").repartition(3)
    partials = partial_sums(df, ["key"], ["n"]).checkpoint(eager=True)
    assert {r.key for r in threshold_candidates(partials, ["key"], "n", 3).collect()} == set(range(8))


@needs_data
def test_threshold_top_categories_equals_the_full_form(spark):
    visits = adapters.visits_from_events(adapters.read_table(spark, SF, "events"))
    for n in (3, 500):
        want = top_categories(category_counts(visits), n)
        assert [tuple(r) for r in threshold_top_categories(visits, n).collect()] == [tuple(r) for r in want.collect()]
    # categories with most clicks lack an order or a payment: more have to be asked for
    rows = [visit(f"s{k}", "2024-01-01 00:00:00", action="click", click=1 + k % 40) for k in range(4000)]
    rows += [visit("o", "2024-01-01 00:00:00", action="order", order=c) for c in (38, 39, 40)] + [visit("p", "2024-01-01 00:00:00", action="pay", pay=c) for c in (39, 40)]
    rows += [visit("c", "2024-01-01 00:00:00", action="click", click=c) for c in range(1, 30) for _ in range(30)]
    some = visits_df(spark, rows, partitions=4)
    assert [tuple(r) for r in threshold_top_categories(some, 2).collect()] == [tuple(r) for r in top_categories(category_counts(some), 2).collect()]


@needs_data
def test_driver_clicks_by_user(spark):
    clicks = load_driver_clicks(spark, SF)
    for name in ("driver_clicks", "driver_clicks_hot"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    save_by_user(clicks, "driver_clicks", 4)
    assert _rows(counts_by_user(spark, "driver_clicks", ["click_date", "user_id", "ad_id"])) == _rows(ads.user_ad_counts(clicks))
