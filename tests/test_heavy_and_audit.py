"""Heavy clickers by state, the stream into a database, and the audit of tables against state."""

import datetime as dt
import glob
import os
import shutil
import sqlite3

import pytest

from visitflow.database import Database
from visitflow.operators import ads
from visitflow.plans import ad_report
from visitflow.schemas import CLICK_SCHEMA
from visitflow.sources import click_lines, load_driver_clicks, read_click_files
from visitflow.streaming import audit_counts, heavy_clickers, read_ad_tables, start_ad_stream, state_batches

SF = "/root/testdata/sf0.01"
AVAILABLE_NOW = {"availableNow": True}
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
UTC = dt.timezone.utc


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def _click(user, ad, day, second):
    at = dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(days=day, seconds=second)
    return ("P", "C", user, ad, int(at.timestamp() * 1000), at, at.date())


def _found(spark, folder, checkpoint, threshold, delay="1 hour"):
    """The rows of every micro-batch and the numbers of state rows after each."""
    clicks = spark.readStream.schema(CLICK_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
    rows = []
    query = heavy_clickers(clicks, threshold, delay).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, k: rows.extend((k, *r) for r in batch.collect())).trigger(availableNow=True).start()
    query.awaitTermination()
    return rows, [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


@pytest.fixture
def rocksdb(spark):
    from visitflow.streaming.ad_stream import _STATE_CONF, ROCKSDB_PROVIDER

    old = spark.conf.get(_STATE_CONF, None)
    spark.conf.set(_STATE_CONF, ROCKSDB_PROVIDER)
    yield
    spark.conf.set(_STATE_CONF, old) if old else spark.conf.unset(_STATE_CONF)


def test_a_user_is_reported_once_at_the_crossing_click(spark, scratch_dir, rocksdb):
    parts = [
        [_click(1, 5, 0, s) for s in range(2)] + [_click(2, 5, 0, 0), _click(2, 6, 0, 1)] + [_click(3, 9, 0, s) for s in range(7)],
        [_click(1, 5, 0, 100), _click(1, 5, 0, 200), _click(1, 6, 0, 201), _click(2, 5, 0, 5)],   # user 1 crosses at second 100
        [_click(1, 5, 1, s) for s in range(9)] + [_click(2, 5, 1, 0)],                            # again heavy: not reported again
    ]
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows + [("P", "C", None, 1, 0, None, None)], CLICK_SCHEMA).coalesce(1).write.parquet(f"{scratch_dir}/in/part={k}")
    found, _ = _found(spark, f"{scratch_dir}/in", f"{scratch_dir}/ckpt", 3)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    assert sorted(found) == [(0, 3, dt.date(2024, 1, 1), 9, at(2)), (1, 1, dt.date(2024, 1, 1), 5, at(100))]


def test_state_stays_flat_over_many_days(spark, scratch_dir, rocksdb):
    days = 10
    for day in range(days):
        rows = [_click(user, ad, day, 60 * ad + user) for user in range(12) for ad in range(4)]
        spark.createDataFrame(rows, CLICK_SCHEMA).coalesce(1).write.parquet(f"{scratch_dir}/in/part={day:02}")
    found, sizes = _found(spark, f"{scratch_dir}/in", f"{scratch_dir}/ckpt", 5)
    assert found == [] and len(sizes) >= days
    # without timers the counts alone would be days * 48 rows
    assert max(sizes) <= max(sizes[:5]) and max(sizes) < days * 48, sizes


@needs_data
def test_state_finds_the_users_of_the_counts(spark, scratch_dir, rocksdb):
    clicks = load_driver_clicks(spark, SF)
    clicks.select(*CLICK_SCHEMA.names).repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{scratch_dir}/all")
    for k, file in enumerate(sorted(glob.glob(f"{scratch_dir}/all/*.parquet"))):
        os.makedirs(f"{scratch_dir}/in/part={k}")
        shutil.copy(file, f"{scratch_dir}/in/part={k}")
    found, _ = _found(spark, f"{scratch_dir}/in", f"{scratch_dir}/ckpt", 2, "1 day")
    want = sorted(r.user_id for r in ads.blacklist_candidates(ads.user_ad_counts(clicks), 2).collect())
    assert sorted(r[1] for r in found) == want and len(want) > 20


def _stream(spark, lines_dir, out_dir, **kw):
    stream = start_ad_stream(spark, read_click_files(spark, lines_dir, max_files_per_trigger=1), out_dir, trigger=AVAILABLE_NOW,
                             max_files_per_trigger=4, trend_method="window", watermark_delay="400 days", **kw)
    stream.await_all()
    return stream


def _lines(spark, path, before="2030-01-01"):
    clicks = load_driver_clicks(spark, SF).where(f"click_date < '{before}'")
    click_lines(clicks.repartitionByRange(2, "ts_ms").sortWithinPartitions("ts_ms")).write.text(path)
    return clicks


def _forget_last_commits(ckpt):
    for query_dir in glob.glob(f"{ckpt}/[a-z]*"):
        commits = sorted(glob.glob(f"{query_dir}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
        os.remove(commits[-1])
        crc = f"{os.path.dirname(commits[-1])}/.{os.path.basename(commits[-1])}.crc"
        if os.path.exists(crc):
            os.remove(crc)


@needs_data
@pytest.mark.parametrize("detect", ["counts", "state"])
def test_stream_into_a_database_equals_batch_and_replay_changes_nothing(spark, scratch_dir, detect):
    db = Database({"database": f"{scratch_dir}/ads.db", "timeout": 60})
    clicks = _lines(spark, f"{scratch_dir}/lines", before="2024-01-04")
    # users found by one run are blocked from the next one on, so one threshold is beyond reach
    threshold = 10**9 if detect == "counts" else 1
    kw = {"database": db, "detect": detect, "threshold": threshold, "apply_blacklist": detect == "counts"}
    _stream(spark, f"{scratch_dir}/lines", f"{scratch_dir}/out", **kw)
    batch = ad_report(spark, clicks, threshold=threshold)
    want = {name: _rows(frame) for name, frame in batch.items()}
    tables = lambda: {name: _rows(db.read(spark, name, frame.schema)) for name, frame in batch.items()}
    assert tables() == want
    _forget_last_commits(f"{scratch_dir}/out/_checkpoints")
    _stream(spark, f"{scratch_dir}/lines", f"{scratch_dir}/out", **kw)
    assert tables() == want
    assert not os.path.exists(f"{scratch_dir}/out/ad_stat")
    # the audit reads the tables where they are
    names = {name: frame.schema for name, frame in batch.items()}
    read = lambda name: db.read(spark, name, names[name])
    assert audit_counts(spark, f"{scratch_dir}/out", read_table=read).count() == 0
    with sqlite3.connect(f"{scratch_dir}/ads.db") as c:
        c.execute("UPDATE ad_stat SET click_count = click_count + 5 WHERE rowid = 3")
    [wrong] = audit_counts(spark, f"{scratch_dir}/out", read_table=read).collect()
    assert (wrong.table, wrong.table_count - wrong.state_count) == ("ad_stat", 5)


@needs_data
def test_audit_reports_a_lost_row(spark, scratch_dir):
    _lines(spark, f"{scratch_dir}/lines", before="2024-01-06")
    out = f"{scratch_dir}/out"
    _stream(spark, f"{scratch_dir}/lines", out, threshold=10**9)
    assert audit_counts(spark, out).count() == 0
    [daily] = state_batches(spark, f"{out}/_checkpoints/daily").where("store = 'default'").collect()
    assert daily.operator == "stateStoreSave" and daily.last_batch >= 0
    # a file of the table is lost
    lost = sorted(glob.glob(f"{out}/ad_stat/*/*/*.parquet"))[0]
    rows = spark.read.parquet(lost).count()
    os.remove(lost)
    wrong = audit_counts(spark, out).collect()
    assert rows > 0 and len(wrong) <= rows and wrong and all(r.table == "ad_stat" and r.table_count != r.state_count for r in wrong)
    assert read_ad_tables(spark, out)["ad_daily_count"].count() > 0


@needs_data
def test_stream_with_state_detection_lists_the_same_users(spark, scratch_dir):
    clicks = _lines(spark, f"{scratch_dir}/lines", before="2024-01-10")
    _stream(spark, f"{scratch_dir}/lines", f"{scratch_dir}/out", threshold=2, detect="state", apply_blacklist=False)
    want = sorted(r.user_id for r in ads.blacklist_candidates(ads.user_ad_counts(clicks), 2).collect())
    assert sorted(r.user_id for r in read_ad_tables(spark, f"{scratch_dir}/out")["ad_blacklist"].collect()) == want
