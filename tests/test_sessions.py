"""Session application: aggregate, join, filters, histograms, shares."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, explain_text, rows
from visitlens.functions.params import TaskParams
from visitlens.operators import sessions as ses

ACTIONS = ("session_id string, user_id long, action_time timestamp_ntz, "
           "search_keyword string, click_category_id long")
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _sessions(spark, visits=(), steps=()):
    data = [(f"v{i}", 1, v, 1) for i, v in enumerate(visits)] + [(f"s{i}", 1, 5, s) for i, s in enumerate(steps)]
    return spark.createDataFrame(data, "session_id string, user_id long, visit_length long, step_length long")


def _hist(df, metric):
    return {r["bucket"]: r["n"] for r in df.where(F.col("metric") == metric).collect()}


def test_coarse_visit_buckets(spark):
    s = _sessions(spark, visits=[0, 1, 30, 31, 120, 121, 300, 301, 6000, 6001])
    got = _hist(ses.bucket_counts(s, ses.COARSE_SPEC), "visit_length")
    assert got == {"0s": 1, "30s": 2, "120s": 2, "300s": 2, "6000s": 2, "mt6000s": 1}


def test_coarse_step_buckets(spark):
    s = _sessions(spark, steps=[1, 10, 11, 30, 31, 60, 61])
    got = _hist(ses.bucket_counts(s, ses.COARSE_SPEC), "step_length")
    assert got == {"step10": 2, "step30": 2, "step60": 2, "mtstep60": 1}


def test_fine_visit_buckets_zero_in_none(spark):
    s = _sessions(spark, visits=[0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801])
    got = _hist(ses.bucket_counts(s, ses.FINE_SPEC), "visit_length")
    assert got == {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2,
                   "3m_10m": 2, "10m_30m": 2, "30m": 1}
    assert sum(got.values()) == 17  # the 0-second session is in no bucket


def test_fine_step_buckets(spark):
    s = _sessions(spark, steps=[1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61])
    got = _hist(ses.bucket_counts(s, ses.FINE_SPEC), "step_length")
    assert got == {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 1}


def test_empty_buckets_show_zero_and_null_share(spark):
    s = _sessions(spark).limit(0)
    out = ses.bucket_counts(s, ses.FINE_SPEC, with_share=True).collect()
    assert len(out) == 15 and all(r["n"] == 0 and r["total"] == 0 and r["ratio"] is None for r in out)


def test_share_half_up(spark):
    s = _sessions(spark, visits=[2, 100, 100, 100, 100, 100, 100, 100])  # 1 of 8 in 1s_3s
    out = {r["bucket"]: r["ratio"] for r in ses.bucket_counts(s, ses.FINE_SPEC, with_share=True)
           .where("metric = 'visit_length'").collect()}
    assert out["1s_3s"] == 0.13 and out["1m_3m"] == 0.88


def test_session_agg_sets_and_lengths(spark):
    acts = spark.createDataFrame([
        ("a", 7, T0, "green tea pot", 15), ("a", 7, T0 + dt.timedelta(seconds=65, microseconds=900), "tea", 5),
        ("a", 7, T0 + dt.timedelta(seconds=1), "", 5), ("a", 7, T0 + dt.timedelta(seconds=2), None, None),
        ("b", 8, T0, None, None),
    ], ACTIONS)
    got = {r["session_id"]: r for r in ses.session_agg(acts).collect()}
    a = got["a"]
    assert (a["user_id"], a["step_length"], a["visit_length"]) == (7, 4, 65)
    assert a["click_category_ids"] == [5, 15]
    assert sorted(a["search_keywords"]) == sorted(["green tea pot", "tea"])
    b = got["b"]
    assert (b["search_keywords"], b["click_category_ids"], b["step_length"], b["visit_length"]) == ([], [], 1, 0)


def test_visit_length_cuts_to_whole_seconds(spark):
    acts = spark.createDataFrame([("a", 1, T0 + dt.timedelta(microseconds=999_999), None, None),
                                  ("a", 1, T0 + dt.timedelta(seconds=1), None, None)], ACTIONS)
    assert ses.session_agg(acts).first()["visit_length"] == 1


def _joined(spark):
    return spark.createDataFrame([
        ("s1", ["kw1", "kw2"], [3, 4], 5, 10, 25, "IT", "c1", "male", 1),
        ("s2", [], [], 1, 0, 40, "IT", "c2", "female", 2),
        ("s3", ["kw9"], [7], 2, 3, None, "law", "c1", None, 3),
    ], "session_id string, search_keywords array<string>, click_category_ids array<long>, step_length long, "
       "visit_length long, age int, professional string, city string, sex string, user_id long")


def _ids(df):
    return sorted(r[0] for r in df.select("session_id").collect())


def test_filter_optional_range_needs_both_bounds(spark):
    j = _joined(spark)
    assert _ids(ses.session_filter(j, TaskParams(start_age=30))) == ["s1", "s2", "s3"]
    assert _ids(ses.session_filter(j, TaskParams(start_age=20, end_age=30))) == ["s1"]


def test_filter_overlap_equal_and_missing_data(spark):
    j = _joined(spark)
    assert _ids(ses.session_filter(j, TaskParams(keywords=("kw2", "c")))) == ["s1"]
    assert _ids(ses.session_filter(j, TaskParams(keywords=("c",)))) == []
    assert _ids(ses.session_filter(j, TaskParams(category_ids=("7", "4")))) == ["s1", "s3"]
    assert _ids(ses.session_filter(j, TaskParams(cities=("c1",), professionals=("IT",)))) == ["s1"]
    # a set filter rejects a missing value; an unset filter passes it
    assert _ids(ses.session_filter(j, TaskParams(sex="male"))) == ["s1"]
    assert _ids(ses.session_filter(j, TaskParams())) == ["s1", "s2", "s3"]


def test_unknown_user_in_coarse_not_in_join(spark):
    sessions = spark.createDataFrame([("s1", 1, [], [], 1, 0), ("s2", 99, [], [], 1, 0)],
                                     "session_id string, user_id long, search_keywords array<string>, "
                                     "click_category_ids array<long>, step_length long, visit_length long")
    users = spark.createDataFrame([(1, 30, "IT", 5, "male")],
                                  "user_id long, age int, professional string, city_key int, sex string")
    cities = spark.createDataFrame([(5, "c"), (6, "d")], "city_key int, city string")
    assert _ids(ses.session_user_join(sessions, users, cities)) == ["s1"]
    assert _hist(ses.bucket_counts(sessions, ses.COARSE_SPEC), "visit_length")["0s"] == 2
    tot = ses.session_totals(sessions, users).first()
    assert (tot["total_sessions"], tot["sessions_with_user"], tot["total_actions"]) == (2, 1, 2)


def test_date_range_is_inclusive_and_pushed_down(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    acts = ses.date_range(ses.actions_from_events(ev), "2024-01-03", "2024-01-04")
    dates = {r[0] for r in acts.select("date").distinct().collect()}
    assert dates == {"2024-01-03", "2024-01-04"}
    plan = explain_text(acts)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-03T00:00)" in plan


def test_task_stats_one_row_per_task(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    users = ses.users_from_customer(spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
    cities = ses.cities_from_nation(spark.read.parquet(f"{SF_SMALL}/nation.parquet"))
    acts = ses.actions_from_events(ev, "week")
    texts = ["{}", "{'startDate':['2023-01-01'],'endDate':['2023-01-02']}",
             "{'startDate':['2024-01-01'],'endDate':['2024-01-10'],'sex':['male']}",
             "{'endDate':['2024-01-08'],'startAge':['20'],'endAge':['45'],'cities':['NATION_2,NATION_9'],"
             "'professionals':['BUILDING,MACHINERY'],'keywords':['kw2,kw4,kw6']}", "{'categoryIds':['4,8,15']}"]
    tasks = spark.createDataFrame(list(enumerate(texts, 1)), "task_id long, params string")
    got = {r["task_id"]: r for r in ses.session_task_stats(acts, users, cities, tasks).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[2]["session_count"] == 0 and got[2]["visit_length_1s_3s_ratio"] is None
    # task 1 equals the single-task pipeline
    single = ses.session_user_join(ses.session_agg(acts), users, cities).count()
    assert got[1]["session_count"] == single
    for i, text in enumerate(texts, 1):
        alone = ses.filtered_sessions(acts, users, cities, TaskParams.from_json(text)).count()
        assert got[i]["session_count"] == alone, text


def test_partition_invariance(spark):
    """The same answer with 1 and 8 shuffle partitions (no per-task state)."""
    from visitlens.plans.queries import QUERIES

    out = {}
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            out[n] = sorted(rows(QUERIES["session_buckets_coarse"](spark, SF_SMALL)))
            out[(n, "r")] = sorted(rows(QUERIES["session_bucket_ratio"](spark, SF_SMALL)), key=str)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[1] == out[8] and out[(1, "r")] == out[(8, "r")]


def test_task_stats_persist_per_task(spark):
    import tempfile

    from visitlens.plans.queries import QUERIES
    from visitlens.sources import write_table

    stats = QUERIES["session_task_stats"](spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="task-stats-") + "/stats"
    write_table(stats, path, partition_by=["task_id"])
    back = spark.read.parquet(path)
    assert back.count() == 4
    assert sorted(r["task_id"] for r in back.select("task_id").collect()) == [1, 2, 3, 4]
    # re-persisting one task replaces that task only
    write_table(stats.where("task_id = 2"), path, partition_by=["task_id"])
    again = spark.read.parquet(path)
    assert sorted(r["task_id"] for r in again.select("task_id").collect()) == [1, 2, 3, 4]


def test_session_report_reuses_one_materialised_table(spark):
    from visitlens.plans import queries as Q

    acts, (users, cities) = Q._actions(spark, SF_SMALL, Q.FINE_GRAIN), Q._users(spark, SF_SMALL)
    report = ses.session_report(acts, users, cities, Q.FILTER_TASK)
    assert sorted(rows(report["ratios"]), key=repr) == sorted(
        rows(Q.QUERIES["session_bucket_ratio"](spark, SF_SMALL)), key=repr)
    assert report["sessions"].count() == Q.QUERIES["session_filter"](spark, SF_SMALL).count()
    # the reused table is a plain parquet scan: lineage is cut
    plan = explain_text(report["ratios"])
    assert "session-report" in plan and "events.parquet" not in plan
    assert report["totals"].first()["session_count"] == report["sessions"].count()
