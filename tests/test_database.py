"""The database source and sinks against an SQLite file (no server; only this machine sees the file)."""

import datetime as dt
import glob
import os
import sqlite3

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from visitflow.database import EPOCHS, Database, DatabaseSource, _Settings, _StreamWriter, register
from visitflow.operators import ads
from visitflow.plans import ad_report, session_job
from visitflow.schemas import BLACKLIST_SCHEMA, TABLE_KEYS
from visitflow.sources import load_blacklist, load_driver_clicks, load_driver_inputs

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture
def db(spark, scratch_dir):
    register(spark)
    return Database({"database": f"{scratch_dir}/results.db", "timeout": 60})


def query(db, text, *values):
    with sqlite3.connect(db.connect["database"]) as c:
        return c.execute(text, values).fetchall()


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


SCHEMA = "task_id long, name string, day date, at timestamp_ntz, score double, fine boolean"


def test_values_of_every_type_come_back(spark, db):
    rows = [(1, "é'; --", dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 23, 59, 59, 123456), 0.1, True), (2, None, None, None, None, None), (None, "", None, None, -1.5, False)]
    df = spark.createDataFrame(rows, SCHEMA)
    db.create_table("t", df.schema)
    db.append(df, "t")
    assert _rows(db.read(spark, "t", df.schema)) == _rows(df)
    assert _rows(db.read(spark, "t", "name string")) == _rows(df.select("name"))
    with_zone = df.selectExpr("task_id", "cast(at as timestamp) as at")
    db.create_table("z", with_zone.schema)
    db.append(with_zone, "z")
    assert _rows(db.read(spark, "z", with_zone.schema)) == _rows(with_zone)


def test_a_rerun_replaces_its_task_also_by_nothing(spark, db):
    df = spark.range(1000).selectExpr("1L as task_id", "id").repartition(7)
    db.create_table("t", df.schema)
    for task, n in ((1, 1000), (2, 30), (1, 1000)):
        db.append(spark.range(n).selectExpr(f"{task}L as task_id", "id").repartition(7), "t", {"task_id": task})
    assert query(db, "SELECT task_id, COUNT(*), COUNT(DISTINCT id) FROM t GROUP BY 1 ORDER BY 1") == [(1, 1000, 1000), (2, 30, 30)]
    db.append(df.limit(0), "t", {"task_id": 1})
    assert query(db, "SELECT task_id, COUNT(*) FROM t GROUP BY 1") == [(2, 30)]
    df.limit(5).write.format("visitflow_db").options(**db.options("t")).mode("overwrite").save()
    assert query(db, "SELECT task_id, COUNT(*) FROM t GROUP BY 1") == [(1, 5)]
    assert query(db, "SELECT COUNT(*) FROM t__staged") == [(0,)]


def test_a_failed_task_leaves_the_table_as_it_was(spark, db):
    df = spark.range(100).selectExpr("1L as task_id", "id")
    db.create_table("t", df.schema)
    db.append(df, "t", {"task_id": 1})
    broken = spark.range(0, 400, 1, 4).selectExpr("1L as task_id", "if(id = 399, raise_error('planned'), id) as id")
    with pytest.raises(Exception, match="planned"):
        db.append(broken, "t", {"task_id": 1})
    assert query(db, "SELECT COUNT(*), MAX(id) FROM t") == [(100, 99)]
    assert query(db, "SELECT COUNT(*) FROM t__staged") == [(0,)]


def batches(n, start=0):
    return iter([pa.RecordBatch.from_pydict({"task_id": [1] * n, "id": list(range(start, start + n))})])


def test_attempts_that_spark_did_not_accept_count_for_nothing(spark, db):
    schema = spark.range(1).selectExpr("1L as task_id", "id").schema
    db.create_table("t", schema)
    source = DatabaseSource(db.options("t", scope={"task_id": 1}))
    writer = source.writer(schema, False)
    lost = writer.write(batches(10))          # its executor is lost after the transaction, Spark starts it again
    again, other = writer.write(batches(10)), writer.write(batches(5, 10))
    assert lost.token != again.token and query(db, "SELECT COUNT(*) FROM t") == [(0,)]
    writer.commit([again, None, other])
    writer_2 = source.writer(schema, False)
    writer_2.write(batches(99))
    writer_2.abort([None])
    assert query(db, "SELECT COUNT(*), COUNT(DISTINCT id) FROM t") == [(15, 15)]
    assert query(db, "SELECT COUNT(*) FROM t__staged") == [(0,)]


def test_upserts_and_groups_keep_the_newer_epoch(spark, db):
    schema = "d string, k long, v long"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    db.create_table("u", frame(("a", 1, 1)).schema, ["d", "k"])
    db.upsert(frame(("a", 1, 1), ("a", 2, 2)), "u", ["d", "k"], 4, "q")
    db.upsert(frame(("a", 1, 10), ("b", 1, 3)), "u", ["d", "k"], 5, "q")
    db.upsert(frame(("a", 1, 1), ("a", 2, 2)), "u", ["d", "k"], 4, "q")       # a task of epoch 4 that was given up
    assert query(db, "SELECT d, k, v FROM u ORDER BY 1, 2") == [("a", 1, 10), ("a", 2, 2), ("b", 1, 3)]
    db.upsert(frame(("a", 1, 7)), "u", ["d", "k"], 0, "another stream")       # epochs of one query do not bind another
    assert query(db, "SELECT v FROM u WHERE d = 'a' AND k = 1") == [(7,)]

    db.create_table("g", frame(("a", 1, 1)).schema, ["d", "k"])
    db.replace_groups(frame(("a", 1, 1), ("a", 2, 2), ("b", 9, 9)), "g", ["d"], 1, "q")
    db.replace_groups(frame(("a", 3, 3)), "g", ["d"], 2, "q")
    db.replace_groups(frame(("a", 1, 1), ("b", 8, 8)), "g", ["d"], 1, "q")
    assert query(db, "SELECT d, k FROM g ORDER BY 1, 2") == [("a", 3), ("b", 8)]
    with pytest.raises(Exception, match="key columns missing"):
        db.upsert(frame(("a", 1, 1)).drop("k"), "u", ["d", "k"])


def test_filters_and_key_ranges_reach_the_database(spark, db, capsys):
    df = spark.range(1000).selectExpr("id", "concat('n', id % 3) as name", "date_add(date'2024-01-01', cast(id % 40 as int)) as day", "if(id % 10 = 0, null, id) as part")
    db.create_table("t", df.schema)
    db.append(df, "t")
    read = db.read(spark, "t", df.schema, "part", 6)
    assert read.rdd.getNumPartitions() == 6
    assert _rows(read) == _rows(df)
    wanted = "id > 100 and id <= 700 and part is not null and day in (date'2024-01-05', date'2024-01-09') and name = 'n1' and name like '%1'"
    got = read.where(wanted)
    assert _rows(got) == _rows(df.where(wanted)) and got.count() > 3
    got.explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert all(x in pushed for x in ("id", "part", "day")), pushed
    # the reader's own query holds them: rows that fail them never leave the database
    assert db.read(spark, "t", df.schema).where("id = 7").collect()[0].name == "n1"
    empty = spark.createDataFrame([], df.schema)
    db.create_table("e", df.schema)
    assert _rows(db.read(spark, "e", df.schema, "part", 4)) == _rows(empty)
    assert db.read(spark, "t", df.schema, "part", 4).where("part is null").count() == 100


def _forget_last_commit(checkpoint):
    commits = sorted(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = f"{os.path.dirname(commits[-1])}/.{os.path.basename(commits[-1])}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def _feed(spark, folder, k, rows, schema="d string, k long"):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={k}")


def _stream(spark, db, folder, checkpoint, keyed):
    lines = spark.readStream.schema("d string, k long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
    if keyed:
        counts = lines.groupBy("d").count()
        writer = db.stream(counts, "counts", checkpoint, keys=["d"], mode="update")
    else:
        writer = db.stream(lines, "lines", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("keyed", [True, False])
def test_a_replayed_epoch_changes_nothing(spark, db, scratch_dir, keyed):
    folder, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/ckpt"
    table = "counts" if keyed else "lines"
    db.create_table(table, spark.createDataFrame([], "d string, count long" if keyed else "d string, k long").schema, ["d"] if keyed else [], streamed=True)
    columns = "d, count" if keyed else "d, k"
    for k in range(3):
        _feed(spark, folder, k, [("a", k), ("b", 10 + k), (f"only{k}", k)])
    _stream(spark, db, folder, ckpt, keyed)
    first = query(db, f"SELECT {columns}, written_epoch FROM {table} ORDER BY 1, 2")
    assert len(first) == (5 if keyed else 9)
    # killed between the sink's commit and Spark's: the epoch is whole, its tasks write nothing
    _forget_last_commit(ckpt)
    _stream(spark, db, folder, ckpt, keyed)
    assert query(db, f"SELECT {columns}, written_epoch FROM {table} ORDER BY 1, 2") == first
    # killed before the sink's commit: some tasks have written, the epoch is written again
    _forget_last_commit(ckpt)
    query(db, f"DELETE FROM {EPOCHS} WHERE epoch = 2")
    _stream(spark, db, folder, ckpt, keyed)
    assert query(db, f"SELECT {columns}, written_epoch FROM {table} ORDER BY 1, 2") == first
    assert [r[0] for r in query(db, f"SELECT epoch FROM {EPOCHS} ORDER BY 1")] == [0, 1, 2]
    if not keyed:
        query(db, f"DELETE FROM {EPOCHS} WHERE epoch = 2")
        schema = spark.createDataFrame([], "d string, k long").schema
        assert db.read(spark, "lines", schema).count() == 9 and db.read(spark, "lines", schema, committed=True).count() == 6


def test_tasks_of_an_unfinished_epoch_replace_their_rows(spark, db, monkeypatch):
    """Attempts by hand: a task that ran twice, another that was given up."""
    schema = spark.createDataFrame([], "d string, k long").schema
    db.create_table("lines", schema, streamed=True)
    context = type("Context", (), {"getLocalProperty": staticmethod(lambda name: "7" if "batch" in name else "q")})
    monkeypatch.setattr("visitflow.database.TaskContext", type("T", (), {"get": staticmethod(lambda: context)}))
    writer = _StreamWriter(_Settings(DatabaseSource(db.options("lines")).options), schema)
    rows = lambda *r: iter([pa.RecordBatch.from_pydict({"d": [x for x, _ in r], "k": [y for _, y in r]})])
    writer.write(rows(("a", 1)))
    messages = [writer.write(rows(("a", 1))), writer.write(rows(("b", 2)))]
    writer.commit(messages, 7)
    writer.commit([writer.write(rows(("a", 1)))], 7)
    assert query(db, "SELECT d, k FROM lines ORDER BY 1") == [("a", 1), ("b", 2)]


def test_the_blacklist_is_read_again_in_every_micro_batch(spark, db, scratch_dir):
    db.create_table("ad_blacklist", BLACKLIST_SCHEMA, ["user_id"])
    folder, seen = f"{scratch_dir}/clicks", {}
    for k in range(3):
        _feed(spark, folder, k, [(1, k), (2, k), (3, k)], "user_id long, n long")
    clicks = spark.readStream.schema("user_id long, n long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
    listed = load_blacklist(spark, "ad_blacklist", fmt="database", jdbc_options=db.options("ad_blacklist"))

    def batch(frame, batch_id):
        seen[batch_id] = sorted(r.user_id for r in frame.collect())
        db.upsert(spark.createDataFrame([(batch_id + 1,)], BLACKLIST_SCHEMA), "ad_blacklist", ["user_id"], batch_id, "q")

    ads.filter_blacklisted(clicks, listed).writeStream.foreachBatch(batch).option("checkpointLocation", f"{scratch_dir}/c").trigger(
        availableNow=True).start().awaitTermination()
    assert seen == {0: [1, 2, 3], 1: [2, 3], 2: [3]}


@needs_data
def test_session_job_into_the_database(spark, db):
    visits, users = load_driver_inputs(spark, SF, entry.RANGE_START, entry.RANGE_END)
    args = (spark, visits, users, entry.RANGE_START, entry.RANGE_END)
    for _ in range(2):  # a rerun replaces the task's rows
        frames = session_job(*args, task_id=3, write_table=db.task_writer(3))
    for name, frame in frames.items():
        assert _rows(db.read(spark, name, frame.schema)) == _rows(frame), name


@needs_data
def test_ad_report_into_the_database(spark, db, scratch_dir):
    clicks = load_driver_clicks(spark, SF)
    for _ in range(2):
        frames = ad_report(spark, clicks, out_dir=f"{scratch_dir}/out", threshold=2, write_table=db.ad_writer())
    for name, frame in frames.items():
        assert set(TABLE_KEYS[name]) <= set(frame.columns)
        assert _rows(db.read(spark, name, frame.schema)) == _rows(frame), name
