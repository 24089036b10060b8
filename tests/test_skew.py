"""A key holding a large share of all rows: results stay exact, and the plan
reduces the hot key before it is shuffled (partial aggregate / partial
window limit), so no task receives the hot key's raw rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import explain_text, rows
from visitlens.operators import relational as rel
from visitlens.operators import sessions as ses
from visitlens.operators import windows

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _skewed_actions(spark, hot_rows=3000, cold=1000):
    hot = spark.range(hot_rows).select(
        F.lit("hot").alias("session_id"), F.lit(1).cast("long").alias("user_id"),
        (F.lit(T0) + F.make_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("action_time"),
        F.concat(F.lit("kw"), (F.col("id") % 7).cast("string")).alias("search_keyword"),
        (F.col("id") % 5).alias("click_category_id"))
    rest = spark.range(cold).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("session_id"), F.col("id").alias("user_id"),
        F.lit(T0).cast("timestamp_ntz").alias("action_time"), F.lit(None).cast("string").alias("search_keyword"),
        F.lit(None).cast("long").alias("click_category_id"))
    return hot.unionByName(rest).repartition(8)


def test_hot_session_is_exact_and_pre_aggregated(spark):
    acts = _skewed_actions(spark)
    sessions = ses.session_agg(acts)
    hot = sessions.where("session_id = 'hot'").first()
    assert (hot["step_length"], hot["visit_length"]) == (3000, 2999)
    assert hot["search_keywords"] == [f"kw{i}" for i in range(7)] and hot["click_category_ids"] == [0, 1, 2, 3, 4]
    assert sessions.count() == 1001
    plan = explain_text(sessions)
    # the partial aggregate sits below the shuffle on session_id
    assert plan.index("partial_collect_set") > plan.index("Exchange hashpartitioning(session_id")


def test_hot_group_top_n_is_cut_before_shuffle(spark):
    df = spark.range(5000).select((F.when(F.col("id") < 4000, 0).otherwise(F.col("id"))).alias("g"),
                                  F.col("id"), (F.col("id") * 7 % 1000).alias("score")).repartition(8)
    top = rel.group_top_n(df, ["g"], [F.col("score").desc(), F.col("id")], 3)
    want = sorted(rows(df.where("g = 0").orderBy(F.col("score").desc(), "id").limit(3), "id"))
    assert sorted(rows(top.where("g = 0"), "id")) == want
    plan = explain_text(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_window_counts_exact(spark):
    ts = [T0 + dt.timedelta(seconds=s) for s in range(0, 50)]
    data = [(t, "hot") for t in ts] * 20 + [(T0, "cold1"), (T0, "cold2")]
    df = spark.createDataFrame(data, "ts timestamp_ntz, keyword string").repartition(8)
    out = windows.hot_search(df, "60 seconds", "60 seconds", 3)
    assert sorted(rows(out, "keyword", "search_count", "rank")) == [("cold1", 1, 2), ("cold2", 1, 3), ("hot", 1000, 1)]
