"""Command line entry points (they reuse the running test session)."""

import os
import tempfile

from conftest import SF_SMALL


def test_query_to_parquet(spark):
    from visitlens.__main__ import main

    out = os.path.join(tempfile.mkdtemp(prefix="cli-"), "counts")
    main(["query", "count_by_key", "--sf-dir", SF_SMALL, "--out", out])
    assert spark.read.parquet(out).count() == 5


def test_stream_running_count_once(spark):
    from visitlens.__main__ import main

    base = tempfile.mkdtemp(prefix="cli-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("x y\nx\n")
    main(["stream", "running-count", "--source", "text", "--path", src, "--out", os.path.join(base, "out"),
          "--once"])
    got = {r["word"]: r["count"] for r in spark.read.parquet(os.path.join(base, "out", "data")).collect()}
    assert got == {"x": 2, "y": 1}


def test_one_tasks_run_leaves_the_other_tasks_rows(spark, tmp_path):
    from visitlens.__main__ import main
    from visitlens.plans import queries as Q

    out = str(tmp_path / "stats")
    main(["query", "session_task_stats", "--sf-dir", SF_SMALL, "--out", out])
    assert sorted(r["task_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]
    one = dict(Q.QUERIES)
    try:
        Q.QUERIES["session_task_stats"] = lambda s, d: one["session_task_stats"](s, d).where("task_id = 3")
        main(["query", "session_task_stats", "--sf-dir", SF_SMALL, "--out", out])
    finally:
        Q.QUERIES.update(one)
    assert sorted(r["task_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]
