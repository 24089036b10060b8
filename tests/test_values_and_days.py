"""Session values as rows, tasks' days that prune partitions, and text folders by arrival time."""

import os
from datetime import timezone

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, explain_text, rows
from visitlens.operators import layout, session_values, sessions, task_days
from visitlens.plans import queries as q
from visitlens.session import fresh_path
from visitlens.sources import read_lines, text_dir_stream, write_lines
from visitlens.streaming import jobs
from visitlens.streaming.runner import StreamTable

TASKS = ["{'startDate':['2024-01-03'],'endDate':['2024-01-04']}", "{'startDate':['2024-01-06'],'endDate':['2024-01-07'],'sex':['male']}",
         "{'startDate':['2030-01-01'],'endDate':['2030-02-01']}", "{'startDate':['2024-01-09'],'endDate':['2024-01-08']}"]


def _tasks(spark, texts=TASKS):
    return spark.createDataFrame(list(enumerate(texts, 1)), "task_id long, params string")


def test_values_are_the_elements_of_the_sets(spark):
    acts = q._actions(spark, SF_SMALL)
    got = {}
    for s, kind, value in rows(session_values.session_values(acts)):
        assert value not in got.setdefault((s, kind), set())
        got[s, kind].add(value)
    counts = {s: (k, c) for s, k, c in rows(session_values.session_value_counts(acts))}
    want = rows(sessions.session_agg(acts), "session_id", "search_keywords", "click_category_ids")
    assert len(want) == len(counts)
    for s, words, categories in want:
        assert got.get((s, "keyword"), set()) == set(words)
        assert got.get((s, "category"), set()) == {str(c) for c in categories}
        assert counts[s] == (len(words), len(categories))


@pytest.mark.parametrize("task", q.STAT_TASK_JSONS + ["{'keywords':['kw1'],'categoryIds':['3,4']}", "{'keywords':['']}"])
def test_fixed_size_rows_pass_the_same_filters(spark, task):
    params = q.TaskParams.from_json(task)
    acts, users = q._actions(spark, SF_SMALL, "week"), q._users(spark, SF_SMALL)
    want = sessions.filtered_sessions(acts, *users, params).drop("search_keywords", "click_category_ids")
    got = session_values.filtered_facts(acts, *users, params)
    assert "collect_set" not in explain_text(got)
    assert sorted(rows(got, *want.columns)) == sorted(rows(want))


def test_semi_joins_find_sessions_by_their_values(spark):
    acts = q._actions(spark, SF_SMALL)
    wanted = spark.createDataFrame([("kw1",), ("kw3",), ("kw3",), (None,)], "value string")
    facts = session_values.session_facts(acts)
    got = rows(session_values.sessions_with(facts, session_values.session_values(acts), "keyword", wanted), "session_id")
    want = [s for s, words in rows(sessions.session_agg(acts), "session_id", "search_keywords") if {"kw1", "kw3"} & set(words)]
    assert sorted(s for s, in got) == sorted(want)


def test_a_session_of_many_values_has_no_large_row(spark):
    n = 1_000_000
    acts = spark.range(n).select(
        F.lit("crawler").alias("session_id"), F.lit(1).cast("long").alias("user_id"), F.timestamp_seconds("id").alias("action_time"),
        F.concat(F.lit("word"), "id").alias("search_keyword"), (F.col("id") % 7).alias("click_category_id"))
    assert rows(session_values.session_value_counts(acts)) == [("crawler", n, 7)]
    facts = session_values.session_facts(acts, q.TaskParams.from_json("{'keywords':['word999999'],'categoryIds':['9']}"))
    assert rows(facts, "step_length", "visit_length", "keyword_hit", "category_hit") == [(n, n - 1, True, False)]


def test_values_of_nothing(spark):
    empty = q._actions(spark, SF_SMALL).where("false")
    assert rows(session_values.session_values(empty)) == [] and rows(session_values.session_value_counts(empty)) == []
    assert rows(session_values.session_facts(empty)) == []


def _rows_scanned(df):
    """Rows that the scans of the main stage gave when ``df`` ran."""
    df._jdf.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    if plan.nodeName().startswith("ResultQueryStage"):
        plan = plan.plan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.length()) if "Scan parquet" in leaves.apply(i).nodeName()]
    return sum(s.metrics().get("numOutputRows").get().value() for s in scans)


def test_days_of_tasks_prune_partitions(spark):
    acts, users = q._actions(spark, SF_SMALL, "week"), q._users(spark, SF_SMALL)
    by_day = layout.save_by_day(acts)
    assert by_day.schema["date"].dataType == acts.schema["date"].dataType and by_day.count() == acts.count()
    tasks = _tasks(spark)
    pruned = task_days.prune_days(by_day, tasks)
    assert "dynamicpruning" in explain_text(pruned)
    days = {r[0] for r in rows(pruned.select("date").distinct())}
    assert days == {"2024-01-03", "2024-01-04", "2024-01-06", "2024-01-07"} & {r[0] for r in rows(acts.select("date").distinct())}
    assert _rows_scanned(pruned) == acts.where(F.col("date").isin(sorted(days))).count()  # the day between the ranges is not read
    got = sorted(rows(task_days.task_stats_by_day(by_day, *users, tasks)))
    assert got == sorted(rows(sessions.session_task_stats(acts, *users, tasks))) and [r[0] for r in got] == [1, 2, 3, 4]


def test_tasks_without_bounds_and_without_days(spark):
    acts = layout.save_by_day(q._actions(spark, SF_SMALL, "week"))
    assert task_days.prune_days(acts, _tasks(spark, ["{}"])).count() == acts.count()
    assert task_days.prune_days(acts, _tasks(spark, TASKS[2:])).count() == 0
    assert task_days.prune_days(acts, _tasks(spark).where("false")).count() == 0


def _folder(spark, files):
    """Text files ``(second, lines)`` that came at the given seconds."""
    path = fresh_path(spark, "arrivals").removeprefix("file:")
    os.makedirs(path)
    for i, (second, lines) in enumerate(files):
        name = os.path.join(path, f"part-{i}.txt")
        with open(name, "w", newline="") as f:
            f.write("".join(line + "\n" for line in lines))
        os.utime(name, (second, second))
    return path


def test_arrival_intervals_do_not_depend_on_batches(spark):
    start = 1_700_000_000
    files = [(start, ["a b", "a"]), (start + 1, ["b", ""]), (start + 4, ["a\rb"]), (start + 5, ["c  d "]), (start + 61, ["a"]), (start + 2, ["a a"])]
    path = _folder(spark, files)
    want = {}
    for second, lines in files:
        for line in lines:
            tokens = line.split(" ") if line else [""]
            while line and tokens and not tokens[-1]:
                tokens.pop()
            for token in tokens:
                key = second // 5 * 5, token
                want[key] = want.get(key, 0) + 1
    for at_once in (1, 4, None):
        table = StreamTable.fresh(spark, "arrival")
        got = jobs.arrival_word_count(spark, text_dir_stream(spark, path, at_once, "\n", arrival=True), table)
        assert {(int(t.timestamp()) if t.tzinfo else int(t.replace(tzinfo=timezone.utc).timestamp()), w): n
                for t, w, n in rows(got.select(F.col("interval_start"), "word", "count"))} == want
        assert len([n for n in os.listdir(table.output.removeprefix("file:")) if n.startswith("batch_id=")]) == {1: 6, 4: 2, None: 1}[at_once]


def test_arrival_counts_restart_where_they_stopped(spark):
    path, table = _folder(spark, [(1_700_000_000, ["a", "b"])]), StreamTable.fresh(spark, "arrival-restart")

    def total():
        counts = jobs.arrival_word_count(spark, text_dir_stream(spark, path, 1, "\n", arrival=True), table)
        return dict(rows(counts.groupBy("word").agg(F.sum("count"))))

    assert total() == {"a": 1, "b": 1}
    with open(os.path.join(path, "late.txt"), "w") as f:
        f.write("b\n")
    os.utime(os.path.join(path, "late.txt"), (1_700_000_001, 1_700_000_001))  # an interval that was written before
    assert total() == {"a": 1, "b": 2} and total() == {"a": 1, "b": 2}


def test_lines_are_written_and_read_as_files(spark):
    lines = spark.createDataFrame([("a b",), ("",), ("x\ry",), ("ü",)], "value string")
    path = write_lines(lines, fresh_path(spark, "lines"))
    assert sorted(rows(read_lines(spark, path, "\n"))) == sorted(rows(lines))
    assert read_lines(spark, path).count() == 5  # CR ends a line too
