"""The command line jobs on inputs derived from the driver's sf0.001 tables."""

import os

import pytest

import __spark_entry__ as entry
from conftest import range_results
from visitflow import cli
from visitflow.sources import click_lines, load_driver_clicks, load_driver_inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def test_session_command(spark, scratch_dir):
    visits, users = load_driver_inputs(spark, SF)
    visits.write.parquet(f"{scratch_dir}/visits")
    users.write.parquet(f"{scratch_dir}/users")
    cli.main(["--master", "local[2]", "session", "--visits", f"{scratch_dir}/visits", "--users", f"{scratch_dir}/users",
              "--start", entry.RANGE_START, "--end", entry.RANGE_END, "--out", f"{scratch_dir}/out"])
    got = spark.read.parquet(f"{scratch_dir}/out/session_detail")
    assert _rows(got) == _rows(range_results(spark, SF)["session_detail"])
    hist = spark.read.parquet(f"{scratch_dir}/out/session_step").drop("task_id")
    assert _rows(hist) == _rows(range_results(spark, SF)["session_histogram"])


def test_ads_command(spark, scratch_dir):
    click_lines(load_driver_clicks(spark, SF)).write.text(f"{scratch_dir}/lines")
    with open(f"{scratch_dir}/lines/part-bad.txt", "w") as fh:
        fh.write("not,a,click\n")
    cli.main(["--master", "local[2]", "ads", "--clicks-dir", f"{scratch_dir}/lines", "--out", f"{scratch_dir}/out"])
    got = spark.read.parquet(f"{scratch_dir}/out/ad_province_top3")
    assert _rows(got) == _rows(entry.queries()["province_top_ads"](spark, SF))
    assert spark.read.parquet(f"{scratch_dir}/out/rejected_lines").count() == 1


def test_ads_stream_command_available_now(spark, scratch_dir):
    from visitflow.streaming import read_ad_tables

    clicks = load_driver_clicks(spark, SF)
    click_lines(clicks).write.text(f"{scratch_dir}/lines")
    cli.main(["--master", "local[2]", "ads-stream", "--lines-dir", f"{scratch_dir}/lines", "--out", f"{scratch_dir}/out",
              "--checkpoint-dir", f"{scratch_dir}/ckpt", "--available-now", "--threshold", "1000000000"])
    got = read_ad_tables(spark, f"{scratch_dir}/out")["ad_province_top3"]
    assert _rows(got) == _rows(entry.queries()["province_top_ads"](spark, SF))
