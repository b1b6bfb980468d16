"""Stream = batch on the driver's clicks fed in several files and micro-batches; a replayed
micro-batch changes nothing; the blacklist grown by one run filters the next one."""

import glob
import os

import pytest

from visitflow.plans import ad_report
from visitflow.sources import click_lines, load_driver_clicks, read_click_files
from visitflow.streaming import read_ad_tables, start_ad_stream

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
AVAILABLE_NOW = {"availableNow": True}
# open windows too, as the batch report has them
ALL_WINDOWS = {"trend_method": "window", "watermark_delay": "400 days"}


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def _write_lines(spark, clicks, path, files):
    # event-time order across files: file i holds the i-th slice of the click times
    click_lines(clicks.repartitionByRange(files, "ts_ms").sortWithinPartitions("ts_ms")).write.text(path)


def _run(spark, lines_dir, out_dir, ckpt, **kw):
    stream = start_ad_stream(spark, read_click_files(spark, lines_dir, max_files_per_trigger=1), out_dir,
                             checkpoint_dir=ckpt, trigger=AVAILABLE_NOW, **kw)
    stream.await_all()
    return stream


def test_stream_equals_batch_and_replay_is_idempotent(spark, scratch_dir):
    clicks = load_driver_clicks(spark, SF)
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    _write_lines(spark, clicks, lines_dir, 3)
    _run(spark, lines_dir, out_dir, ckpt, threshold=10**9, max_files_per_trigger=4, **ALL_WINDOWS)
    assert len(glob.glob(f"{ckpt}/clean/commits/*")) == 3  # three micro-batches

    batch = ad_report(spark, clicks, spark.createDataFrame([], "user_id long"), threshold=10**9)
    streamed = read_ad_tables(spark, out_dir)
    snapshot = {}
    for name, frame in batch.items():
        got = _rows(streamed[name])
        assert got == _rows(frame), name
        snapshot[name] = got
    assert len(snapshot["ad_click_trend"]) == 112893

    # replay: forget the last commit of every query, restart, the tables must not change
    for query_dir in glob.glob(f"{ckpt}/[a-z]*"):
        commits = sorted(glob.glob(f"{query_dir}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
        last = commits[-1]
        os.remove(last)
        crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    _run(spark, lines_dir, out_dir, ckpt, threshold=10**9, max_files_per_trigger=4, **ALL_WINDOWS)
    again = read_ad_tables(spark, out_dir)
    for name in batch:
        assert _rows(again[name]) == snapshot[name], name


def test_blacklist_feedback_blocks_later_clicks(spark, scratch_dir):
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    os.makedirs(lines_dir)
    first = ["P,C,1,5,1704067200000", "P,C,1,5,1704067201000", "P,C,1,5,1704067202000", "P,C,2,5,1704067203000",
             "bad line"]
    with open(f"{lines_dir}/part-1.txt", "w") as fh:
        fh.write("\n".join(first) + "\n")
    _run(spark, lines_dir, out_dir, ckpt, threshold=3)
    tables = read_ad_tables(spark, out_dir)
    assert [r.user_id for r in tables["ad_blacklist"].collect()] == [1]
    assert spark.read.parquet(f"{out_dir}/rejected_lines").count() == 1

    # a new session knows the folder but not the catalog entry: the table is re-registered and its
    # earlier batches recovered (dropping the external table keeps its files)
    from visitflow.streaming import blacklist_table_name
    spark.sql(f"DROP TABLE {blacklist_table_name(out_dir)}")
    with open(f"{lines_dir}/part-2.txt", "w") as fh:
        fh.write("P,C,1,5,1704067300000\nP,C,2,5,1704067301000\n")
    _run(spark, lines_dir, out_dir, ckpt, threshold=3)
    counts = {r.user_id: r.click_count for r in read_ad_tables(spark, out_dir)["ad_user_click_count"].collect()}
    assert counts == {1: 3, 2: 2}   # user 1's later click is blocked, user 2 keeps counting
    top = read_ad_tables(spark, out_dir)["ad_province_top3"].collect()
    assert [(r.province, r.ad_id, r.click_count) for r in top] == [("P", 5, 5)]


def test_watermarked_stream_equals_batch(spark, scratch_dir):
    clicks = load_driver_clicks(spark, "/root/testdata/sf0.001")
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    _write_lines(spark, clicks, lines_dir, 3)
    stream = _run(spark, lines_dir, out_dir, ckpt, threshold=10**9, watermark_delay="2 hours", count_watermark_delay="2 hours",
                  trend_method="window")
    batch = ad_report(spark, clicks, spark.createDataFrame([], "user_id long"), threshold=10**9)
    streamed = read_ad_tables(spark, out_dir)
    for name, frame in batch.items():
        assert _rows(streamed[name]) == _rows(frame), name
    # the watermark evicts closed minutes and days: the state holds far fewer rows than the tables
    for name, table in (("minute", "ad_minute_count"), ("daily", "ad_daily_count")):
        kept = [p["stateOperators"][0]["numRowsTotal"] for p in stream.queries[name].recentProgress
                if p.get("stateOperators")][-1]
        assert kept < streamed[table].count() / 2, (name, kept)


def test_coded_behaviour_counts_blacklisted_users(spark, scratch_dir):
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    os.makedirs(lines_dir)
    with open(f"{lines_dir}/part-1.txt", "w") as fh:
        fh.write("P,C,1,5,1704067200000\nP,C,1,5,1704067201000\n")
    _run(spark, lines_dir, out_dir, ckpt, threshold=2, apply_blacklist=False)
    with open(f"{lines_dir}/part-2.txt", "w") as fh:
        fh.write("P,C,1,5,1704067300000\n")
    _run(spark, lines_dir, out_dir, ckpt, threshold=2, apply_blacklist=False)
    tables = read_ad_tables(spark, out_dir)
    assert [r.user_id for r in tables["ad_blacklist"].collect()] == [1]
    assert [r.click_count for r in tables["ad_user_click_count"].collect()] == [3]
    assert spark.read.parquet(f"{out_dir}/ad_blacklist").count() == 1   # listed once, not per batch


def test_blacklist_loader_replaces_the_table_read(spark, scratch_dir):
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    os.makedirs(lines_dir)
    with open(f"{lines_dir}/part-1.txt", "w") as fh:
        fh.write("P,C,1,5,1704067200000\nP,C,2,5,1704067201000\n")
    spark.createDataFrame([(2,)], "user_id long").write.parquet(f"{scratch_dir}/external_blacklist")
    calls = []

    def loader(session):
        calls.append(1)
        return session.read.parquet(f"{scratch_dir}/external_blacklist")

    _run(spark, lines_dir, out_dir, ckpt, threshold=100, blacklist_loader=loader)
    counts = {r.user_id: r.click_count for r in read_ad_tables(spark, out_dir)["ad_user_click_count"].collect()}
    assert counts == {1: 1}
    assert calls


def test_chained_trend_writes_closed_windows_once(spark, scratch_dir):
    from pyspark.sql import functions as F

    from visitflow.operators import ad_trend

    clicks = load_driver_clicks(spark, "/root/testdata/sf0.001")
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    _write_lines(spark, clicks, lines_dir, 3)
    _run(spark, lines_dir, out_dir, ckpt, threshold=10**9, watermark_delay="10 minutes")
    got = read_ad_tables(spark, out_dir)["ad_click_trend"]
    latest = clicks.agg(F.max("ts")).collect()[0][0]
    closed = ad_trend(clicks).where(
        F.col("window_end") <= F.lit(latest).cast("timestamp_ntz") - F.expr("INTERVAL 10 MINUTES"))
    assert _rows(got) == _rows(closed)
    assert spark.read.parquet(f"{out_dir}/ad_click_trend").count() == got.count()   # one write per window


def test_continuous_trigger_reaches_the_batch_result(spark, scratch_dir):
    clicks = load_driver_clicks(spark, "/root/testdata/sf0.001")
    lines_dir, out_dir, ckpt = (f"{scratch_dir}/{x}" for x in ("lines", "out", "ckpt"))
    _write_lines(spark, clicks, lines_dir, 3)
    stream = start_ad_stream(spark, read_click_files(spark, lines_dir, max_files_per_trigger=1), out_dir,
                             checkpoint_dir=ckpt, trigger={"processingTime": "1 second"}, threshold=10**9)
    expected = _rows(ad_report(spark, clicks, spark.createDataFrame([], "user_id long"), threshold=10**9)["ad_stat"])
    try:
        stream.process_all_available()
        assert _rows(read_ad_tables(spark, out_dir)["ad_stat"]) == expected
        assert all(q.isActive for q in stream.queries.values())
    finally:
        stream.stop()
    assert not any(q.isActive for q in stream.queries.values())


def test_blacklist_table_name_cannot_point_elsewhere(spark, scratch_dir):
    from visitflow.streaming import ensure_blacklist_table

    ensure_blacklist_table(spark, "bl_location_check", f"{scratch_dir}/a")
    ensure_blacklist_table(spark, "bl_location_check", f"{scratch_dir}/a/")   # same place: fine
    with pytest.raises(ValueError):
        ensure_blacklist_table(spark, "bl_location_check", f"{scratch_dir}/b")


FIRST_RUN = """
import sys
from visitflow.config import build_session
from visitflow.sources import read_click_files
from visitflow.streaming import start_ad_stream
lines, out, warehouse = sys.argv[1:]
spark = build_session(master="local[2]", shuffle_partitions=2, extra={"spark.sql.warehouse.dir": warehouse})
start_ad_stream(spark, read_click_files(spark, lines), out, trigger={"availableNow": True}, threshold=10**9,
                trend_method="window", watermark_delay="400 days").await_all()
spark.stop()
"""


def test_two_applications_lose_no_clicks(spark, scratch_dir):
    """The default checkpoint belongs to the output folder, not to the application."""
    import subprocess
    import sys

    lines_dir, out_dir = f"{scratch_dir}/lines", f"{scratch_dir}/out"
    os.makedirs(lines_dir)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for part in range(2):
        with open(f"{lines_dir}/part-{part}.txt", "w") as fh:
            fh.write("".join(f"P{i % 2},C,{i % 4},{part},{1704067200000 + (part * 10 + i) * 60000}\n" for i in range(10)))
        subprocess.run([sys.executable, "-c", FIRST_RUN, lines_dir, out_dir, f"{scratch_dir}/wh{part}"], check=True,
                       env={**os.environ, "PYTHONPATH": root}, cwd=scratch_dir, capture_output=True)
    from visitflow.sources import parse_clicks
    from visitflow.streaming import blacklist_table_name, ensure_blacklist_table

    ensure_blacklist_table(spark, blacklist_table_name(out_dir), f"{out_dir}/ad_blacklist")
    clicks, _ = parse_clicks(spark.read.text(lines_dir))
    batch = ad_report(spark, clicks, spark.createDataFrame([], "user_id long"), threshold=10**9)
    got = read_ad_tables(spark, out_dir)
    for name, frame in batch.items():
        assert _rows(got[name]) == _rows(frame), name


def test_foreign_and_lost_checkpoints_are_refused(spark, scratch_dir):
    lines_dir = f"{scratch_dir}/lines"
    os.makedirs(lines_dir)
    with open(f"{lines_dir}/part-1.txt", "w") as fh:
        fh.write("P,C,1,5,1704067200000\n")
    for out in ("a", "b"):  # two outputs in one application: each has its own checkpoint
        _run(spark, lines_dir, f"{scratch_dir}/{out}", None)
        assert [r.click_count for r in read_ad_tables(spark, f"{scratch_dir}/{out}")["ad_stat"].collect()] == [1]
    with pytest.raises(ValueError, match="not its checkpoint"):
        _run(spark, lines_dir, f"{scratch_dir}/a", f"{scratch_dir}/new")
    with pytest.raises(ValueError, match="not of"):
        _run(spark, lines_dir, f"{scratch_dir}/a", f"{scratch_dir}/b/_checkpoints")
    with pytest.raises(ValueError, match="watermark_delay"):
        _run(spark, lines_dir, f"{scratch_dir}/c", None, watermark_delay=None)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            _run(spark, lines_dir, f"{scratch_dir}/d", None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_failed_query_is_noticed(spark, scratch_dir):
    lines_dir, out_dir = f"{scratch_dir}/lines", f"{scratch_dir}/out"
    os.makedirs(lines_dir)
    with open(f"{lines_dir}/part-1.txt", "w") as fh:
        fh.write("P,C,1,5,1704067200000\n")

    def broken(name, rows, batch_id):
        raise OSError("no database")

    stream = start_ad_stream(spark, read_click_files(spark, lines_dir), out_dir, trigger={"processingTime": "1 second"},
                             write_table=broken)
    with pytest.raises(RuntimeError, match="failed"):
        stream.await_all(timeout=60)
    assert not any(q.isActive for q in stream.queries.values())


def test_writer_gets_every_table_and_new_blacklisted_users(spark, scratch_dir):
    lines_dir, out_dir = f"{scratch_dir}/lines", f"{scratch_dir}/out"
    os.makedirs(lines_dir)
    with open(f"{lines_dir}/part-1.txt", "w") as fh:
        fh.write("P,C,1,5,1704067200000\nP,C,1,5,1704067201000\nP,C,2,5,1704067201000\n")
    written = {}
    _run(spark, lines_dir, out_dir, None, threshold=2, trend_method="window",
         write_table=lambda name, rows, batch: written.setdefault(name, []).extend(tuple(r) for r in rows.collect()))
    assert written["ad_blacklist"] == [(1,)]
    assert len(written["ad_province_top3"]) == 1 and len(written["ad_click_trend"]) == 60
    assert set(written) == {"ad_daily_count", "ad_province_top3", "ad_stat", "ad_user_click_count", "ad_click_trend",
                            "ad_minute_count", "ad_blacklist"}


def test_windowed_state_stays_flat(spark, scratch_dir):
    """Twelve micro-batches of two hours each: the state holds the hours behind the watermark, not all."""
    lines_dir, out_dir = f"{scratch_dir}/lines", f"{scratch_dir}/out"
    os.makedirs(lines_dir)
    for part in range(12):
        with open(f"{lines_dir}/part-{part:02d}.txt", "w") as fh:
            fh.write("".join(f"P,C,1,{i % 3},{1704067200000 + (part * 120 + i) * 60000}\n" for i in range(120)))
        os.utime(f"{lines_dir}/part-{part:02d}.txt", (1704067200 + part, 1704067200 + part))
    stream = start_ad_stream(spark, read_click_files(spark, lines_dir, max_files_per_trigger=1), out_dir, trigger=AVAILABLE_NOW,
                             threshold=10**9, watermark_delay="30 minutes", max_files_per_trigger=1)
    stream.await_all()
    for name in ("trend", "minute"):
        rows = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in stream.queries[name].recentProgress if p["stateOperators"]]
        assert len(rows) >= 12 and max(rows[6:]) <= 1.2 * max(rows[:6]), rows
    assert set(stream.late_clicks().values()) == {0}
    from visitflow.sources import parse_clicks

    clicks, _ = parse_clicks(spark.read.text(lines_dir))
    assert _rows(read_ad_tables(spark, out_dir)["ad_minute_count"]) == _rows(ad_report(spark, clicks)["ad_minute_count"])
