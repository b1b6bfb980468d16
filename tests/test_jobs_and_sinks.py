import datetime as dt
import os

import pytest

import __spark_entry__ as entry
from conftest import range_results
from visitflow.plans import session_job
from visitflow.sinks import (
    batches_of, fold, jdbc_writer, merge_sql, mysql_upsert_sql, read_groups, read_task, read_upserted,
    replace_groups, replace_groups_sql, replace_task, upsert,
)
from visitflow.sources import load_blacklist, load_driver_inputs, load_users, load_visits

SF = "/root/testdata/sf0.01"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def test_upsert_latest_wins_and_replay_is_idempotent(spark, scratch_dir):
    path = f"{scratch_dir}/t"
    keys = ["d", "k"]
    upsert(spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], "d string, k long, v long"), path, keys, 0)
    upsert(spark.createDataFrame([("a", 2, 25), ("b", 1, 5)], "d string, k long, v long"), path, keys, 1)
    expected = [("a", "1", "10"), ("a", "2", "25"), ("b", "1", "5")]
    assert _rows(read_upserted(spark, path, keys)) == expected
    upsert(spark.createDataFrame([("a", 2, 25), ("b", 1, 5)], "d string, k long, v long"), path, keys, 1)
    assert _rows(read_upserted(spark, path, keys)) == expected
    assert read_upserted(spark, f"{scratch_dir}/missing", keys) is None


def test_replace_groups_keeps_last_batch_per_group(spark, scratch_dir):
    path = f"{scratch_dir}/g"
    schema = "d string, p string, ad long, n long"
    replace_groups(spark.createDataFrame([("x", "P", 1, 3), ("x", "P", 2, 2), ("x", "Q", 9, 1)], schema), path, ["d", "p"], 0)
    replace_groups(spark.createDataFrame([("x", "P", 2, 4), ("x", "P", 1, 3)], schema), path, ["d", "p"], 1)
    assert _rows(read_groups(spark, path, ["d", "p"])) == [("1", "x", "3", "P"), ("2", "x", "4", "P"), ("9", "x", "1", "Q")]
    with pytest.raises(ValueError):
        replace_groups(spark.createDataFrame([("x", 1)], "d string, n long"), path, ["d", "p"], 2)


def test_a_rerun_task_is_replaced_also_by_nothing(spark, scratch_dir):
    path, schema = f"{scratch_dir}/a", "task_id int, s string"
    one = spark.createDataFrame([(1, "s1"), (1, "s2")], schema)
    replace_task(one, path, 1)
    replace_task(spark.createDataFrame([(2, "s9")], schema), path, 2)
    replace_task(one, path, 1)
    assert spark.read.parquet(path).count() == 3
    replace_task(one.limit(0), path, 1)
    assert read_task(spark, path, one.schema, 1).collect() == [] and read_task(spark, path, one.schema, 1).columns == one.columns
    assert [tuple(r) for r in read_task(spark, path, one.schema, 2).collect()] == [(2, "s9")]


@pytest.mark.parametrize("groups", [False, True])
def test_logs_stay_short_and_replays_change_nothing(spark, scratch_dir, groups):
    """Sixty batches on one date: a bounded number of batch folders and files, whatever is replayed."""
    path, keys = f"{scratch_dir}/log", ["d", "k"]
    want, most = {}, 0

    def batch(n):
        rows = [("2024-01-01", k, n * 100 + k) for k in range(n % 7, 20, 3)] + ([("2024-01-02", 5, n)] if n < 3 else [])
        df = spark.createDataFrame(rows, "d string, k long, v long").coalesce(1)
        fold(spark, path, keys, n, "d", ["2024-01-01"], groups=groups, above=5)
        if groups:
            replace_groups(df, path, keys, n, partition_by=["d"])
        else:
            upsert(df, path, keys, n, partition_by=["d"])
        want.update({(d, k): v for d, k, v in rows})

    for n in range(60):
        batch(n)
        if n % 13 == 0:
            batch(n)  # the same batch again
        most = max(most, len(batches_of(spark, f"{path}/d=2024-01-01")))
    assert most <= 2 * 6 + 1
    import glob

    assert len(glob.glob(f"{path}/d=2024-01-01/*/*.parquet")) <= 13 * 9
    got = read_groups(spark, path, keys) if groups else read_upserted(spark, path, keys)
    assert {(str(r.d), r.k): r.v for r in got.collect()} == want
    if not groups:
        one = read_upserted(spark, path, keys, date_col="d", dates=["2024-01-02", "2024-02-30"])
        assert [(r.k, r.v) for r in one.collect()] == [(5, 2)]


@pytest.mark.parametrize("groups", [False, True])
def test_a_reader_survives_a_fold(spark, scratch_dir, groups):
    """Files listed before a fold are still there after it; they go with the fold after the next."""
    path, keys = f"{scratch_dir}/log", ["d", "k"]
    put = replace_groups if groups else upsert
    read = read_groups if groups else read_upserted

    def batch(n):
        fold(spark, path, keys, n, "d", ["2024-01-01"], groups=groups, above=3)
        put(spark.createDataFrame([("2024-01-01", k, n) for k in range(n % 2, 4)], "d string, k long, v long").coalesce(1), path, keys, n, partition_by=["d"])

    for n in range(4):
        batch(n)
    listed = read(spark, path, keys)          # files are listed here, read below
    files = set(listed.inputFiles())
    batch(4)                                  # folds batches 0 to 3 into 3
    assert len(batches_of(spark, f"{path}/d=2024-01-01")) == 5
    assert {r.k: r.v for r in listed.collect()} == {0: 2, 1: 3, 2: 3, 3: 3}
    for n in range(5, 9):
        batch(n)                              # a second fold: the batches of the first are gone
    assert batches_of(spark, f"{path}/d=2024-01-01")[0] == 3 and files
    assert {r.k: r.v for r in read(spark, path, keys).collect()} == {0: 8, 1: 8, 2: 8, 3: 8}


def test_a_batch_of_many_dates_reads_its_own_folders(spark, scratch_dir):
    path = f"{scratch_dir}/dates"
    days = [str(dt.date(2020, 1, 1) + dt.timedelta(days=k)) for k in range(450)]
    upsert(spark.createDataFrame([(d, 1, 2) for d in days], "d string, k long, v long").coalesce(1), path, ["d", "k"], 0, partition_by=["d"])
    some = read_upserted(spark, path, ["d", "k"], date_col="d", dates=days[:400])
    assert some.count() == 400 and len(some.inputFiles()) == 400


def test_text_sources_read_reference_layout(spark, scratch_dir):
    visit_file = f"{scratch_dir}/userVisit.txt"
    with open(visit_file, "w", newline="") as fh:
        fh.write("2019-01-14,7,abc-1,2019-01-14 01:02:03,click,0,0,12,34,0,0,,5\r\n")
        fh.write("2019-01-14,8,abc-2,2019-01-14 13:00:00,search,0,0,0,0,0,0,cake,3\r\n")
    rows = load_visits(spark, visit_file, fmt="csv").orderBy("user_id").collect()
    assert rows[0].action_time == dt.datetime(2019, 1, 14, 1, 2, 3)
    assert (rows[0].click_category_id, rows[0].search_keyword, rows[0].page_id) == (12, None, 5)
    assert rows[1].action_time.hour == 13 and rows[1].search_keyword == "cake"
    from visitflow.schemas import VISIT_SCHEMA
    from visitflow.sources import read_text_rows

    bad = ["2019-01-14,8,abc-3,2019-01-14 25:00:00,search,0,0,0,0,0,0,cake,3", "2019-01-14,8,abc-4"]
    with open(visit_file, "a", newline="") as fh:
        fh.write("".join(f"{line}\r\n" for line in bad))
    rows, rejects = read_text_rows(spark, visit_file, VISIT_SCHEMA)
    assert rows.count() == 2 == load_visits(spark, visit_file, fmt="csv").count()
    assert sorted(r.line.strip() for r in rejects.collect()) == sorted(bad)
    user_file = f"{scratch_dir}/userInfo.txt"
    with open(user_file, "w", newline="") as fh:
        fh.write("7,name7,sex7,7,professional7,33\r\n")
    assert load_users(spark, user_file, fmt="csv").collect()[0].user_age == 33
    assert load_blacklist(spark, f"{scratch_dir}/no-such-table").count() == 0


def test_jdbc_statements():
    assert merge_sql("ad_stat", "s1", ["d", "k"], ["d", "k", "n"]) == (
        "MERGE INTO ad_stat t USING s1 s ON t.d = s.d AND t.k = s.k WHEN MATCHED THEN UPDATE SET n = s.n "
        "WHEN NOT MATCHED THEN INSERT (d, k, n) VALUES (s.d, s.k, s.n)")
    assert mysql_upsert_sql("ad_blacklist", "s", ["user_id"], ["user_id"]) == (
        "INSERT INTO ad_blacklist (user_id) SELECT user_id FROM s ON DUPLICATE KEY UPDATE user_id = VALUES(user_id)")
    assert replace_groups_sql("ad_province_top3", "s", ["click_date", "province"], ["click_date", "province", "ad_id", "click_count"]) == [
        "DELETE FROM ad_province_top3 WHERE EXISTS (SELECT 1 FROM s s WHERE s.click_date = ad_province_top3.click_date "
        "AND s.province = ad_province_top3.province)",
        "INSERT INTO ad_province_top3 (click_date, province, ad_id, click_count) "
        "SELECT click_date, province, ad_id, click_count FROM s",
    ]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_session_job_writes_the_registered_results(spark, scratch_dir):
    visits, users = load_driver_inputs(spark, SF, entry.RANGE_START, entry.RANGE_END)
    out = session_job(spark, visits, users, entry.RANGE_START, entry.RANGE_END, out_dir=f"{scratch_dir}/out")
    q = range_results(spark, SF)
    pairs = {
        "session_random_extract": "sample_sessions",
        "top10_category": "top_categories",
        "top10_category_session": "category_click_events",
        "top10_category_session_ranked": "top_sessions_per_category",
        "session_detail": "session_detail",
    }
    for table, key in pairs.items():
        assert _rows(out[table]) == _rows(q[key]), table
    hist = out["session_step"].drop("task_id")
    assert _rows(hist) == _rows(q["session_histogram"])
    # a rerun of the same task replaces its rows
    out2 = session_job(spark, visits, users, entry.RANGE_START, entry.RANGE_END, out_dir=f"{scratch_dir}/out")
    assert out2["session_detail"].count() == 536


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver test data not present")
def test_session_job_without_visits(spark, scratch_dir):
    """An empty range on a first run, and one that turns a task's tables empty."""
    visits, users = load_driver_inputs(spark, "/root/testdata/sf0.001")
    for out in (f"{scratch_dir}/new", f"{scratch_dir}/full"):
        if out.endswith("full"):
            full = session_job(spark, visits, users, entry.RANGE_START, entry.RANGE_END, out_dir=out)
            assert full["session_detail"].count() > 0
        empty = session_job(spark, visits, users, "1999-01-01 00:00:00", "1999-01-02 00:00:00", out_dir=out)
        counts = {name: frame.count() for name, frame in empty.items()}
        assert counts.pop("session_step") == 9 and set(counts.values()) == {0}
        assert {r.session_count for r in empty["session_step"].collect()} == {0}


def test_jdbc_sequence_and_replay(spark, monkeypatch):
    """What is staged, in which order the statements run; no database is at hand, so execution is not tested."""
    from pyspark.sql import DataFrameWriter

    events = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: events.append(("stage", url, table, mode)))
    write = jdbc_writer("jdbc:x", lambda statements: events.append(("run", *[s.split(" ")[0] for s in statements])))
    counts = spark.createDataFrame([("2024-01-01", "P", 1, 2)], "click_date string, province string, ad_id long, click_count long")
    for _ in range(2):
        write("ad_daily_count", counts, 7)
        write("ad_province_top3", counts, 7)
    once = [("stage", "jdbc:x", "ad_daily_count_staging_7", "overwrite"), ("run", "MERGE"), ("run", "DROP"),
            ("stage", "jdbc:x", "ad_province_top3_staging_7", "overwrite"), ("run", "DELETE", "INSERT"), ("run", "DROP")]
    assert events == once * 2


def test_jdbc_loaders_conform(spark, monkeypatch):
    from visitflow.sources import tables

    asked = []
    monkeypatch.setattr(tables, "read_jdbc", lambda s, t, o=None: (asked.append((t, o)), spark.createDataFrame([(3, "x")], "user_id int, other string"))[1])
    assert load_users(spark, "user_info", fmt="jdbc", jdbc_options={"url": "u"}).first().user_id == 3
    assert load_blacklist(spark, fmt="jdbc", jdbc_options={"url": "u"}).first().user_id == 3
    with pytest.raises(ValueError, match="missing"):
        load_visits(spark, "user_visit", fmt="jdbc", jdbc_options={"url": "u"})
    assert asked == [("user_info", {"url": "u"}), ("ad_blacklist", {"url": "u"}), ("user_visit", {"url": "u"})]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver test data not present")
def test_session_job_custom_writer(spark):
    visits, users = load_driver_inputs(spark, "/root/testdata/sf0.001", entry.RANGE_START, entry.RANGE_END)
    written = {}
    session_job(spark, visits, users, entry.RANGE_START, entry.RANGE_END,
                write_table=lambda name, frame: written.__setitem__(name, frame.count()))
    assert set(written) == {"session_step", "session_random_extract", "top10_category", "top10_category_session",
                            "top10_category_session_ranked", "session_detail"}
    assert written["session_step"] >= 9


def test_table_and_parquet_loaders(spark, scratch_dir):
    from conftest import visit, visits_df

    visits = visits_df(spark, [visit("s1", "2019-01-14 01:00:00"), visit("s2", "2019-01-14 02:00:00")])
    visits.withColumn("extra", visits.page_id * 2).createOrReplaceTempView("user_visit_view")
    assert load_visits(spark, "user_visit_view", fmt="table").columns == visits.columns   # extra column pruned
    spark.createDataFrame([(7, "x")], "user_id long, user_name string").write.parquet(f"{scratch_dir}/users")
    users = load_users(spark, f"{scratch_dir}/users").collect()
    assert (users[0].user_id, users[0].user_name, users[0].user_age) == (7, "x", None)
    spark.createDataFrame([("x",)], "user_name string").write.parquet(f"{scratch_dir}/no_ids")
    with pytest.raises(ValueError):
        load_users(spark, f"{scratch_dir}/no_ids")
