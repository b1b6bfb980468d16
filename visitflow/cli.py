"""Command line entry points for the two jobs.

    python -m visitflow.cli session --visits PATH --users PATH --start TS --end TS --out DIR
    python -m visitflow.cli ads --clicks-dir DIR --out DIR [--blacklist DIR]
    python -m visitflow.cli ads-stream --out DIR (--kafka HOSTS [--topic advice] | --lines-dir DIR)
        [--available-now] [--watermark "1 day"] [--trend chain|window]

Paths may be on any Hadoop file system.  On a cluster the master and ``spark.checkpoint.dir``
come from ``spark-submit``; ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from visitflow.config import SESSION_CONF, build_session
from visitflow.plans import TableCounts, ad_report, session_job
from visitflow.schemas import USER_SCHEMA, VISIT_SCHEMA
from visitflow.sources import (
    load_blacklist, load_users, load_visits, parse_clicks, read_click_files, read_click_stream,
    read_text_rows,
)
from visitflow.streaming import start_ad_stream


def _session(args) -> SparkSession:
    if args.master:
        return build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    builder = SparkSession.builder.appName("visitflow")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="visitflow")
    ap.add_argument("--master")
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("session", help="batch session analysis")
    s.add_argument("--visits", required=True)
    s.add_argument("--users", required=True)
    s.add_argument("--format", default="parquet", choices=["parquet", "csv", "table"])
    s.add_argument("--start", required=True)
    s.add_argument("--end", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--task-id", type=int, default=1)
    s.add_argument("--sample-size", type=int, default=30)
    s.add_argument("--seed", type=int, default=42)

    a = sub.add_parser("ads", help="ad-click tables from a folder of click lines (batch)")
    a.add_argument("--clicks-dir", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--blacklist")
    a.add_argument("--threshold", type=int, default=100)

    st = sub.add_parser("ads-stream", help="ad-click stream")
    st.add_argument("--out", required=True)
    st.add_argument("--kafka")
    st.add_argument("--topic", default="advice")
    st.add_argument("--lines-dir")
    st.add_argument("--checkpoint-dir")
    st.add_argument("--threshold", type=int, default=100)
    st.add_argument("--interval", default="5 seconds")
    st.add_argument("--watermark", default="1 day")
    st.add_argument("--no-blacklist", action="store_true")
    st.add_argument("--available-now", action="store_true",
                    help="process what has arrived, then stop (run the stream as a scheduled job)")
    st.add_argument("--trend", default="chain", choices=["window", "chain"])

    args = ap.parse_args(argv)
    spark = _session(args)
    if args.cmd == "session":
        counts = TableCounts()
        visits = load_visits(spark, args.visits, args.format, counts=counts)
        users = load_users(spark, args.users, args.format, counts=counts)
        if args.format == "csv":
            for name, path, schema in (("visits", args.visits, VISIT_SCHEMA), ("users", args.users, USER_SCHEMA)):
                read_text_rows(spark, path, schema)[1].write.mode("overwrite").text(f"{args.out}/rejected_{name}")
        session_job(spark, visits, users, args.start, args.end, out_dir=args.out, task_id=args.task_id,
                    sample_size=args.sample_size, seed=args.seed, counts=counts)
        for name, found in counts.all().items():
            print(name, *(f"{k}={v}" for k, v in found.items()))
    elif args.cmd == "ads":
        clicks, rejects = parse_clicks(read_click_files(spark, args.clicks_dir, streaming=False))
        blacklist = load_blacklist(spark, args.blacklist) if args.blacklist else None
        ad_report(spark, clicks, blacklist, out_dir=args.out, threshold=args.threshold)
        rejects.write.mode("overwrite").parquet(f"{args.out}/rejected_lines")
    else:
        if args.kafka:
            lines = read_click_stream(spark, args.kafka, args.topic)
        elif args.lines_dir:
            lines = read_click_files(spark, args.lines_dir)
        else:
            raise SystemExit("ads-stream needs --kafka or --lines-dir")
        trigger = {"availableNow": True} if args.available_now else {"processingTime": args.interval}
        stream = start_ad_stream(spark, lines, args.out, checkpoint_dir=args.checkpoint_dir, trigger=trigger,
                                 threshold=args.threshold, apply_blacklist=not args.no_blacklist,
                                 watermark_delay=args.watermark, trend_method=args.trend)
        stream.await_all()


if __name__ == "__main__":
    main()
