"""Command line: run a registered query, or start a streaming job.

    python -m visitlens query session_task_stats --sf-dir DIR --out PATH
    python -m visitlens query word_count --sf-dir DIR --show 20
    python -m visitlens stream hot-goods --source socket --host H --port P --out DIR
    python -m visitlens stream running-count --source kafka --servers S --topics T --out DIR
    python -m visitlens stream batch-word-count --source text --path DIR --out DIR --once

Streaming jobs run until stopped, one micro-batch per interval (the
reference's 2 s for windowed jobs, 5 s for word counts), unless ``--once``
processes what is available and exits. Line sources carry no event time, so
windows use arrival time (``ts`` of the socket / Kafka record, or the batch's
processing time for a text folder). A window is emitted once the watermark
has passed its end, so a ``--once`` run of a windowed job over arrival time
emits only windows that closed before it ended.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from .operators import windows
from .session import build_session, fresh_path
from .sources import socket_lines, text_dir_stream, topic_stream, write_table
from .streaming import jobs
from .streaming.runner import StreamTable

STREAM_JOBS = ("batch-word-count", "topic-word-count", "running-count", "hot-search", "hot-goods")


def _lines(spark, args):
    if args.source == "socket":
        return socket_lines(spark, args.host, args.port)
    if args.source == "kafka":
        return topic_stream(spark, args.servers, args.topics, group_id=args.group_id)
    return text_dir_stream(spark, args.path).withColumn("ts", F.current_timestamp())


def run_stream(spark, args):
    lines = _lines(spark, args)
    base = args.out or fresh_path(spark, args.job)
    table = StreamTable(os.path.join(base, "checkpoint"), os.path.join(base, "data"))
    windowed = args.job in ("hot-search", "hot-goods")
    interval = args.interval or (jobs.WINDOW_INTERVAL if windowed else jobs.WORD_COUNT_INTERVAL)
    trigger = None if args.once else {"processingTime": interval}
    if args.job == "batch-word-count":
        out = jobs.batch_word_count(spark, lines.select("value"), table, trigger=trigger)
    elif args.job == "topic-word-count":
        out = jobs.topic_word_count(spark, lines, table, trigger=trigger)
    elif args.job == "running-count":
        out = jobs.running_word_count(spark, lines.select("value"), table, trigger=trigger)
    elif args.job == "hot-search":
        out = jobs.hot_search_stream(spark, windows.searches_from_lines(lines), table,
                                     args.length, args.slide, args.delay, args.n, trigger=trigger)
    else:
        out = jobs.hot_goods_stream(spark, windows.goods_from_lines(lines), table,
                                    args.length, args.slide, args.delay, args.n, trigger=trigger)
    if trigger is None:
        out.show(args.show, truncate=False)
        print(f"output: {table.output}")
    else:
        print(f"running; output: {table.output}")
        out.awaitTermination()


def run_query(spark, args):
    from .plans.queries import QUERIES

    df = QUERIES[args.key](spark, args.sf_dir)
    if args.out:
        # a task's row replaces that task's only
        write_table(df, args.out, partition_by=["task_id"] if "task_id" in df.columns else None)
        print(f"written: {args.out}")
    else:
        df.show(args.show, truncate=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="visitlens")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="command", required=True)

    q = sub.add_parser("query", help="run a registered query")
    q.add_argument("key")
    q.add_argument("--sf-dir", required=True, help="folder with <table>.parquet files")
    q.add_argument("--out", help="write the result as parquet here instead of showing it")
    q.add_argument("--show", type=int, default=20)

    s = sub.add_parser("stream", help="start a streaming job")
    s.add_argument("job", choices=STREAM_JOBS)
    s.add_argument("--source", choices=("socket", "kafka", "text"), required=True)
    s.add_argument("--host")
    s.add_argument("--port", type=int)
    s.add_argument("--servers", help="Kafka bootstrap servers")
    s.add_argument("--topics")
    s.add_argument("--group-id")
    s.add_argument("--path", help="text folder watched for new files")
    s.add_argument("--out", help="folder for checkpoint/ and data/ (default: under spark.checkpoint.dir)")
    s.add_argument("--interval", help="micro-batch interval, e.g. '5 seconds'")
    s.add_argument("--length", default=windows.DEFAULT_LENGTH)
    s.add_argument("--slide", default=windows.DEFAULT_SLIDE)
    s.add_argument("--delay", default="10 seconds", help="watermark delay")
    s.add_argument("--n", type=int, default=3)
    s.add_argument("--once", action="store_true", help="process what is available, then exit")
    s.add_argument("--show", type=int, default=20)
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master, args.shuffle_partitions)
    if args.command == "query":
        run_query(spark, args)
    else:
        run_stream(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
