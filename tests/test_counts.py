"""Counts that come with a write."""

import subprocess
import sys

import pytest
from conftest import ROOT, visit, visits_df, users_df
from visitflow.operators import session_histogram, session_summary
from visitflow.plans import TableCounts, session_job
from visitflow.schemas import VISIT_SCHEMA
from visitflow.sources import load_visits, read_text_rows


def _visits(spark):
    rows = [visit(f"s{k % 9}", f"2019-01-14 0{1 + k % 3}:{k % 60:02d}:00", user_id=k % 4, page_id=k % 13, action=["click", "order", "pay"][k % 3],
                  click=k % 3, order=k % 3, pay=k % 3) for k in range(300)]
    return visits_df(spark, rows, partitions=5), users_df(spark, range(4))


def test_histogram_and_row_counts_come_with_the_writes(spark, scratch_dir):
    visits, users = _visits(spark)
    counts = TableCounts()
    frames = session_job(spark, visits, users, "2019-01-14 00:00:00", "2019-01-15 00:00:00", out_dir=f"{scratch_dir}/out", counts=counts)
    found = counts.all()
    assert {name: c["rows"] for name, c in found.items() if name != "sessions"} == {name: frame.count() for name, frame in frames.items()}
    want = sorted(map(tuple, session_histogram(session_summary(visits)).collect()))
    assert sorted((r.bucket, r.session_count) for r in frames["session_step"].collect()) == want
    assert found["sessions"]["rows"] == found["sessions"]["sessionCount"] == dict(want)["sessionCount"] > 0


def test_histogram_needs_no_job_of_its_own(spark, scratch_dir):
    visits, users = _visits(spark)
    tracker = spark.sparkContext.statusTracker()

    def jobs(name, run):
        spark.sparkContext.setJobGroup(name, name)
        run()
        spark.sparkContext.setJobGroup("other", "other")
        return len(tracker.getJobIdsForGroup(name))

    summary = lambda: session_summary(visits)
    counts = TableCounts()
    from visitflow.operators.sessions import histogram_metrics

    plain = jobs("plain", lambda: summary().write.parquet(f"{scratch_dir}/a"))
    observed = jobs("observed", lambda: (counts.watch("s", summary(), **histogram_metrics()).write.parquet(f"{scratch_dir}/b"), counts.get("s")))
    assert plain == observed and counts.get("s")["rows"] == spark.read.parquet(f"{scratch_dir}/b").count()


def test_empty_input_gives_a_zero_histogram(spark):
    frames = session_job(spark, visits_df(spark, []), users_df(spark, [1]), "2019-01-14 00:00:00", "2019-01-15 00:00:00")
    rows = dict((r.bucket, r.session_count) for r in frames["session_step"].collect())
    assert len(rows) == 9 and set(rows.values()) == {0}


def test_csv_loader_reports_what_it_leaves_out(spark, scratch_dir):
    good = "2019-01-14,7,abc-1,2019-01-14 01:02:03,click,0,0,12,34,0,0,,5"
    lines = [good, good.replace("01:02:03", "25:00:00"), "2019-01-14,8", good.replace(",34,", ",x,"), good, ""]
    with open(f"{scratch_dir}/visits.txt", "w", newline="") as fh:
        fh.write("".join(f"{x}\r\n" for x in lines))
    counts = TableCounts()
    path = f"{scratch_dir}/visits.txt"
    rows = load_visits(spark, path, fmt="csv", counts=counts)
    rows.select("user_id").write.parquet(f"{scratch_dir}/out")
    rejects = read_text_rows(spark, path, VISIT_SCHEMA)[1].count()
    assert counts.get(path) == {"rows": 2 + rejects, "rejects": rejects} and rejects == 3
    assert spark.read.parquet(f"{scratch_dir}/out").count() == 2


RETRIED = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from visitflow.plans import TableCounts
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def flaky(batches):
    for k, batch in enumerate(batches):
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("planned")

counts = TableCounts()
df = spark.range(0, 1000, 1, 4).withColumn("odd", F.col("id") % 2 == 1)
watched = counts.watch("t", df, odd=F.count_if("odd")).mapInArrow(flaky, df.schema)
watched.write.parquet({out!r})
print("RESULT", counts.get("t"), spark.read.parquet({out!r}).count())
spark.stop()
"""


def test_a_retried_task_counts_once(scratch_dir):
    code = RETRIED.format(root=ROOT, out=f"{scratch_dir}/out")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    result = [line for line in done.stdout.splitlines() if line.startswith("RESULT")]
    assert result == ["RESULT {'rows': 1000, 'odd': 500} 1000"], done.stderr[-2000:]


def test_counts_of_unknown_frames(spark):
    with pytest.raises(KeyError):
        TableCounts().get("nothing")
