"""Session statistics of many tasks by an inverted index of their filter terms.

Testing every task against every session multiplies the two. Here a filter is a set of terms ``(kind, term)``: a city, a profession, a sex,
a keyword, a category or an age of the wanted range. Each task is found through one kind only, the one whose terms the
fewest sessions have; a session is joined to the tasks that its own terms name, and only those pairs are tested in full.
Sessions are merged once for each distinct date range, however many tasks ask for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .materialize import materialize
from .sessions import _task_matches, join_users, merge_day_partials, parse_tasks, session_day_partials, task_rows


def _terms(kind: str, values: Column) -> Column:
    """Distinct terms of one kind; none for a missing list, and no null term."""
    clean = F.filter(F.array_distinct(F.coalesce(values.cast("array<string>"), F.array().cast("array<string>"))), lambda v: v.isNotNull())
    return F.transform(clean, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("term")))


def _one(value: Column) -> Column:
    return F.when(value.isNotNull(), F.array(value.cast("string")))


def ranged_sessions(actions: DataFrame, users: DataFrame, cities: DataFrame, ranges: DataFrame) -> DataFrame:
    """Sessions with their users' columns and ``terms``, once for each ``(range, lo, hi)`` that they have a day in."""
    days = ranges.select("range", F.explode(F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"))).alias("day")).select(
        "range", F.col("day").cast("string").alias("date"))
    merged = merge_day_partials(session_day_partials(actions).join(days, "date"), ("range", "session_id"))
    return join_users(merged, users, cities).withColumn("terms", F.concat(
        _terms("profession", F.split("professional", ",")), _terms("city", F.split("city", ",")), _terms("sex", _one(F.col("sex"))),
        _terms("age", _one(F.col("age"))), _terms("keyword", F.col("search_keywords")), _terms("category", F.col("click_category_ids"))))


def task_filters(tasks: DataFrame, users: DataFrame) -> DataFrame:
    """``(task_id, range, kind, wanted)``: a row for each filter that a task sets. Age ranges are cut to the ages there are."""
    least, most = (users.agg(f("age")).scalar() for f in (F.min, F.max))
    lo, hi = F.greatest(F.col("start_age"), least), F.least(F.col("end_age"), most)
    ages = F.when(F.col("start_age").isNotNull() & F.col("end_age").isNotNull(),
                  F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>")).cast("array<string>"))
    kinds = [("profession", F.col("professionals")), ("city", F.col("cities")), ("sex", _one(F.col("sex"))), ("age", ages),
             ("keyword", F.col("keywords")), ("category", F.col("category_ids"))]
    entries = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("wanted")) for k, v in kinds])
    return (tasks.select("task_id", "range", F.explode(entries).alias("e")).where(F.col("e.wanted").isNotNull())
            .select("task_id", "range", "e.kind", F.array_distinct("e.wanted").alias("wanted")))


def matched_sessions(sessions: DataFrame, tasks: DataFrame, users: DataFrame) -> DataFrame:
    """``(task_id, <session columns>)`` of every session that passes a task's filters; ``sessions`` and ``tasks`` are written tables."""
    filters = task_filters(tasks, users)
    common = sessions.select("range", F.explode("terms").alias("t")).groupBy("range", "t.kind", "t.term").agg(F.count(F.lit(1)).alias("sessions"))
    cost = (filters.withColumn("term", F.explode_outer("wanted")).join(common, ["range", "kind", "term"], "left")
            .groupBy("task_id", "kind").agg(F.sum(F.coalesce("sessions", F.lit(0))).alias("cost")))
    lead = cost.groupBy("task_id").agg(F.min_by("kind", F.struct("cost", "kind")).alias("kind"))
    index = (filters.join(lead, ["task_id", "kind"]).withColumn("term", F.explode("wanted"))
             .join(tasks.drop("range").withColumnRenamed("sex", "t_sex"), "task_id"))
    named = sessions.withColumn("t", F.explode("terms")).withColumns({"kind": F.col("t.kind"), "term": F.col("t.term")}).drop("t")
    met = named.join(index, ["range", "kind", "term"])
    # a session that has several of the wanted terms counts by the first of them
    first = F.expr("get(array_intersect(transform(filter(terms, x -> x.kind = kind), x -> x.term), wanted), 0) = term")
    columns = ["task_id", "session_id", "visit_length", "step_length"]
    free = tasks.select("task_id", "range").join(filters.select("task_id").distinct(), "task_id", "left_anti")
    return met.where(first & _task_matches()).select(*columns).unionByName(sessions.join(free, "range").select(*columns))


def task_stats_by_index(actions: DataFrame, users: DataFrame, cities: DataFrame, tasks: DataFrame) -> DataFrame:
    """The rows of :func:`visitlens.operators.sessions.session_task_stats`, for any number of tasks."""
    parsed = parse_tasks(tasks)
    first_day, last_day = (actions.agg(f("date")).scalar() for f in (F.min, F.max))
    lo, hi = F.greatest(F.col("start_date"), first_day), F.least(F.col("end_date"), last_day)
    bounded = (parsed.withColumns({"lo": lo, "hi": hi}).where(F.col("lo").cast("date") <= F.col("hi").cast("date"))
               .withColumn("range", F.concat_ws("/", "lo", "hi")))
    known = materialize(bounded.drop("start_date", "end_date"), "task-ranges")
    sessions = materialize(ranged_sessions(actions, users, cities, known.select("range", "lo", "hi").distinct()), "range-sessions")
    return task_rows(parsed, matched_sessions(sessions, known.drop("lo", "hi"), users))
