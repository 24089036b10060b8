"""Plans: no jobs while building, join strategy by size, input spreading, task table."""

import json

import pytest

from conftest import SF_SMALL, explain_text
from visitlens.operators import sessions as ses
from visitlens.operators.partitioning import spread
from visitlens.plans.queries import QUERIES


@pytest.mark.parametrize("key", ["session_user_join", "session_totals", "session_task_stats"])
def test_building_a_query_runs_no_job_but_schema_reads(spark, key):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{key}", key)
    try:
        QUERIES[key](spark, SF_SMALL)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one job for each table whose footer is read
    assert len(tracker.getJobIdsForGroup(f"build-{key}")) <= 3


def test_user_join_is_sort_merge_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["session_user_join"](spark, SF_SMALL)
        plan = explain_text(df)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        without = df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert QUERIES["session_user_join"](spark, SF_SMALL).count() == without


def test_every_customer_is_a_user(spark):
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    assert ses.users_from_customer(customer).count() == customer.count()


def _logical_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_task_plan_does_not_grow_with_the_tasks(spark):
    acts = ses.actions_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "week")
    users = ses.users_from_customer(spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
    cities = ses.cities_from_nation(spark.read.parquet(f"{SF_SMALL}/nation.parquet"))
    sizes = set()
    for n in (4, 400):
        rows = [(i, json.dumps({"startDate": ["2024-01-03"], "startAge": [str(i % 30)], "endAge": ["60"]})) for i in range(n)]
        tasks = spark.createDataFrame(rows, "task_id long, params string")
        sizes.add(_logical_size(ses.session_task_stats(acts, users, cities, tasks)))
    assert len(sizes) == 1


def test_spread_only_when_input_is_narrow(spark):
    narrow = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert narrow.rdd.getNumPartitions() == 1
    assert spread(narrow, 4).rdd.getNumPartitions() == 4
    wide = spark.range(0, 1000, numPartitions=8)
    assert spread(wide, 4) is wide
