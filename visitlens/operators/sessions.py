"""Web-session analysis: actions -> sessions -> user join -> task filter ->
visit-length / step-length histograms and shares.

Every function takes and returns lazy DataFrames. The heavy steps are one
``groupBy`` (partial + final hash aggregate, so a session or user holding a
large share of all rows is pre-aggregated in every map task before the
shuffle), joins with the user and city tables (planned from their file sizes),
and global aggregates that shuffle a single row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import whole_seconds_between
from ..functions.numbers import half_up_share
from ..functions.params import TaskParams, param_first, parse_params

GRAINS = ("day", "week", "month")

# ---------------------------------------------------------------------------
# Histogram edges (inclusive whole numbers; None = no upper end).
# Coarse edges apply to all sessions before the user join; fine edges apply to
# the sessions left after the join and the task filter. A 0-second session has
# its own coarse bucket and falls in no fine time bucket.
COARSE_VISIT_BUCKETS = [
    ("0s", 0, 0), ("30s", 1, 30), ("120s", 31, 120), ("300s", 121, 300),
    ("6000s", 301, 6000), ("mt6000s", 6001, None),
]
COARSE_STEP_BUCKETS = [
    ("step10", 1, 10), ("step30", 11, 30), ("step60", 31, 60), ("mtstep60", 61, None),
]
FINE_VISIT_BUCKETS = [
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30),
    ("30s_60s", 31, 60), ("1m_3m", 61, 180), ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800), ("30m", 1801, None),
]
FINE_STEP_BUCKETS = [
    ("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30),
    ("30_60", 31, 60), ("60", 61, None),
]
COARSE_SPEC = [("visit_length", COARSE_VISIT_BUCKETS), ("step_length", COARSE_STEP_BUCKETS)]
FINE_SPEC = [("visit_length", FINE_VISIT_BUCKETS), ("step_length", FINE_STEP_BUCKETS)]
# ---------------------------------------------------------------------------

USER_ATTRIBUTES = ["age", "professional", "city", "sex"]


# -- inputs -------------------------------------------------------------------

def actions_from_events(events: DataFrame, grain: str = "day") -> DataFrame:
    """Map the ``events`` table onto the user-visit-action layout.

    A session is one user's events of one day / ISO week / month. ``view``
    carries a search keyword, ``click`` a category and product, ``signup`` an
    order, ``purchase`` a payment; ``error`` rows carry no attribute.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    period = {
        "day": F.date_format("ts", "yyyy-MM-dd"),
        "week": F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"),
        "month": F.date_format("ts", "yyyy-MM"),
    }[grain]
    product = F.col("event_id") % 100
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("user_id"),
        F.concat_ws("_", F.col("user_id").cast("string"), period).alias("session_id"),
        (F.col("event_id") % 10).alias("page_id"),
        F.col("ts").alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(kind == "click", k).alias("click_category_id"),
        F.when(kind == "click", product).alias("click_product_id"),
        F.when(kind == "signup", k.cast("string")).alias("order_category_ids"),
        F.when(kind == "signup", product.cast("string")).alias("order_product_ids"),
        F.when(kind == "purchase", k.cast("string")).alias("pay_category_ids"),
        F.when(kind == "purchase", product.cast("string")).alias("pay_product_ids"),
    )


def users_from_customer(customer: DataFrame) -> DataFrame:
    """User attributes from ``customer``, one row per customer. The city is a
    key into :func:`cities_from_nation`, joined only where it is needed."""
    key = F.col("c_custkey")
    return customer.select(
        key.alias("user_id"), F.col("c_name").alias("username"), F.col("c_name").alias("name"),
        (key % 60).cast("int").alias("age"), F.col("c_mktsegment").alias("professional"),
        F.col("c_nationkey").alias("city_key"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"))


def cities_from_nation(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").alias("city_key"), F.col("n_name").alias("city"))


def date_range(actions: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Actions whose date lies in ``[start_date, end_date]`` (inclusive, ``yyyy-MM-dd``).

    Written as a range on ``action_time`` (not on the formatted date text) so
    that Catalyst pushes it into the parquet scan as min/max row-group
    pruning. Bounds are values, never spliced into SQL text.
    """
    cond = _date_cond(actions, start_date, end_date)
    return actions if cond is None else actions.where(cond)


def _date_cond(actions: DataFrame, start_date: str | None, end_date: str | None) -> Column | None:
    ts_type = actions.schema["action_time"].dataType.simpleString()
    t = F.col("action_time")
    conds = []
    if start_date is not None:
        conds.append(t >= F.lit(start_date).cast("date").cast(ts_type))
    if end_date is not None:
        conds.append(t < F.date_add(F.lit(end_date).cast("date"), 1).cast(ts_type))
    return reduce(lambda a, b: a & b, conds) if conds else None


# -- session aggregate ----------------------------------------------------------

def session_agg(actions: DataFrame, keys: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """One row per session: user, distinct non-empty search keywords and
    distinct click categories (sorted arrays), step count, and visit length in
    whole seconds (``max - min`` of the action times cut to seconds).

    Each aggregate is partial-then-final; the two sets only grow with the
    number of *distinct* values in a session, not with its rows. Pass
    ``keys=("user_id", "session_id")`` on input bucketed by ``user_id``
    (``operators.layout``) to aggregate without a shuffle.
    """
    kw = F.col("search_keyword")
    # With ``user_id`` among the keys (user-bucketed input), it is a key, not an aggregate.
    user = [] if "user_id" in keys else [F.min("user_id").alias("user_id")]
    return actions.groupBy(*keys).agg(
        *user,
        F.array_sort(F.collect_set(F.when(kw != "", kw))).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        F.count(F.lit(1)).alias("step_length"),
        whole_seconds_between(F.min("action_time"), F.max("action_time"),
                              _is_wall_clock(actions, "action_time")).alias("visit_length"),
    )


def _is_wall_clock(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() == "timestamp_ntz"


def sessions_as_text(sessions: DataFrame) -> DataFrame:
    """Set columns rendered as comma-joined text (the record's edge form)."""
    return sessions.withColumns({
        "search_keywords": F.array_join("search_keywords", ","),
        "click_category_ids": F.array_join(F.col("click_category_ids").cast("array<string>"), ","),
    })


def join_users(rows: DataFrame, users: DataFrame, cities: DataFrame) -> DataFrame:
    """``rows`` with their user's attributes (inner joins on ``user_id``, then ``city_key``).

    Both sides are joined as base tables, one after the other, so the planner knows
    their file sizes: a small one is broadcast under ``autoBroadcastJoinThreshold``, a
    large one is sort-merged and AQE splits a hot user. No hint and no counting job."""
    named = users.select("user_id", "age", "professional", "sex", "city_key")
    return rows.join(named, "user_id").join(cities, "city_key").drop("city_key")


def session_user_join(sessions: DataFrame, users: DataFrame, cities: DataFrame) -> DataFrame:
    """Sessions with their user's age, profession, city and sex (inner join:
    sessions of unknown users drop out)."""
    return join_users(sessions, users, cities).select(
        "session_id", "search_keywords", "click_category_ids", "step_length", "visit_length",
        *USER_ATTRIBUTES, "user_id")


# -- task filter ----------------------------------------------------------------

def _overlaps(values: Column, wanted: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(values, F.array(*[F.lit(v) for v in wanted])), F.lit(False))


def task_predicate(p: TaskParams) -> Column:
    """AND of the optional filters, in the order age, profession, city, sex,
    keywords, categories. An unset filter passes; a set filter rejects a
    session whose field is missing."""
    conds: list[Column] = []
    if p.start_age is not None and p.end_age is not None:
        conds.append(F.coalesce(F.col("age").between(p.start_age, p.end_age), F.lit(False)))
    if p.professionals is not None:
        conds.append(_overlaps(F.split("professional", ","), p.professionals))
    if p.cities is not None:
        conds.append(_overlaps(F.split("city", ","), p.cities))
    if p.sex is not None:
        conds.append(F.coalesce(F.col("sex") == F.lit(p.sex), F.lit(False)))
    if p.keywords is not None:
        conds.append(_overlaps(F.col("search_keywords"), p.keywords))
    if p.category_ids is not None:
        conds.append(_overlaps(F.col("click_category_ids").cast("array<string>"), p.category_ids))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def session_filter(joined: DataFrame, params: TaskParams) -> DataFrame:
    return joined.where(task_predicate(params))


def filtered_sessions(actions: DataFrame, users: DataFrame, cities: DataFrame, params: TaskParams) -> DataFrame:
    """The task's date range -> sessions -> user join -> task filter."""
    sessions = session_agg(date_range(actions, params.start_date, params.end_date))
    return session_filter(session_user_join(sessions, users, cities), params)


# -- statistics -----------------------------------------------------------------

def _in_bucket(c: Column, lo: int, hi: int | None) -> Column:
    return (c >= lo) if hi is None else c.between(lo, hi)


def bucket_counts(sessions: DataFrame, spec=COARSE_SPEC, with_share: bool = False) -> DataFrame:
    """Histogram in long form ``(metric, bucket, bucket_order, n)``; empty
    buckets show 0. With ``with_share`` also ``total`` and the HALF_UP share.

    One pass, no join: every bucket is a conditional count of a single global
    aggregate (one partial row per task is shuffled), then unpivoted.
    """
    aggs, rows = [F.count(F.lit(1)).alias("total")], []
    for metric, buckets in spec:
        for i, (name, lo, hi) in enumerate(buckets):
            alias = f"{metric}__{i}"
            aggs.append(F.count_if(_in_bucket(F.col(metric), lo, hi)).alias(alias))
            fields = [F.lit(metric).alias("metric"), F.lit(name).alias("bucket"),
                      F.lit(i).alias("bucket_order"), F.col(alias).alias("n")]
            if with_share:
                fields += [F.col("total"), half_up_share(F.col(alias), F.col("total")).alias("ratio")]
            rows.append(F.struct(*fields))
    return sessions.agg(*aggs).select(F.inline(F.array(*rows)))


def session_totals(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Actions (sum of steps), sessions, and sessions whose user is known."""
    dim = users.select(F.col("user_id").alias("known_user"))
    return (sessions.join(dim, sessions["user_id"] == dim["known_user"], "left")
            .agg(F.sum("step_length").alias("total_actions"),
                 F.count(F.lit(1)).alias("total_sessions"),
                 F.count("known_user").alias("sessions_with_user")))


def session_day_partials(actions: DataFrame) -> DataFrame:
    """Partial session aggregates per ``(session_id, date)``: the exact
    building blocks of any session restricted to whole days."""
    kw = F.col("search_keyword")
    return actions.groupBy("session_id", "date").agg(
        F.min("user_id").alias("user_id"),
        F.collect_set(F.when(kw != "", kw)).alias("keyword_set"),
        F.collect_set("click_category_id").alias("category_set"),
        F.count(F.lit(1)).alias("steps"),
        F.min("action_time").alias("first_time"),
        F.max("action_time").alias("last_time"),
    )


def merge_day_partials(partials: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sessions from their day partials; same columns as :func:`session_agg`.
    The gathered lists hold at most one set per day of the session."""
    return partials.groupBy(*keys).agg(
        F.min("user_id").alias("user_id"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keyword_set")))).alias("search_keywords"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("category_set")))).alias("click_category_ids"),
        F.sum("steps").alias("step_length"),
        whole_seconds_between(F.min("first_time"), F.max("last_time"),
                              _is_wall_clock(partials, "first_time")).alias("visit_length"),
    )


TASK_COLUMNS = ["start_date", "end_date", "start_age", "end_age", "professionals", "cities", "sex", "keywords",
                "category_ids"]


def parse_tasks(tasks: DataFrame) -> DataFrame:
    """``(task_id, <TASK_COLUMNS>)`` of a table ``(task_id, params)`` with JSON parameters; an absent one is NULL."""
    p = parse_params(F.col("params"))

    def first(name: str) -> Column:
        return param_first(p, name)

    def many(name: str) -> Column:
        return F.split(first(name), ",")

    return tasks.select(
        F.col("task_id").cast("long").alias("task_id"), first("startDate").alias("start_date"), first("endDate").alias("end_date"),
        first("startAge").cast("int").alias("start_age"), first("endAge").cast("int").alias("end_age"),
        many("professionals").alias("professionals"), many("cities").alias("cities"), first("sex").alias("sex"),
        many("keywords").alias("keywords"), many("categoryIds").alias("category_ids"))


def _task_matches() -> Column:
    """The optional filters of :func:`task_predicate`, read from the task's own columns."""
    def unset_or(unset: Column, cond: Column) -> Column:
        return unset | F.coalesce(cond, F.lit(False))

    def overlap(wanted: str, values: Column) -> Column:
        return unset_or(F.col(wanted).isNull(), F.arrays_overlap(values, F.col(wanted)))

    return (unset_or(F.col("start_age").isNull() | F.col("end_age").isNull(),
                     F.col("age").between(F.col("start_age"), F.col("end_age")))
            & overlap("professionals", F.split("professional", ","))
            & overlap("cities", F.split("city", ","))
            & unset_or(F.col("t_sex").isNull(), F.col("sex") == F.col("t_sex"))
            & overlap("keywords", F.col("search_keywords"))
            & overlap("category_ids", F.col("click_category_ids").cast("array<string>")))


def session_task_stats(actions: DataFrame, users: DataFrame, cities: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row per task: ``task_id, session_count`` and the 15 fine-bucket shares.

    ``tasks`` is a table ``(task_id, params)``; the plan is the same for any number of tasks.
    Actions are first reduced to per-day session partials; a task is a row for
    each day of its range (cut to the days there are), joined on the day, so the fan-out
    grows with session-days, not with actions. Sessions are merged per ``(task_id, session_id)``, the
    task's filter is read from its columns, and one ``groupBy(task_id)`` counts buckets. A task that
    matches nothing still gets a row (0 sessions, NULL shares).
    """
    parsed = parse_tasks(tasks)
    partials = session_day_partials(actions)
    # a task without a bound takes the data's; the two scalars are subqueries, run once
    first_day, last_day = (actions.agg(f("date")).scalar() for f in (F.min, F.max))
    lo, hi = F.col("lo").cast("date"), F.col("hi").cast("date")
    days = (parsed.select("task_id", F.greatest(F.col("start_date"), first_day).alias("lo"), F.least(F.col("end_date"), last_day).alias("hi"))
            .where(lo <= hi).select("task_id", F.explode(F.sequence(lo, hi)).alias("day"))
            .select("task_id", F.col("day").cast("string").alias("date")))
    per_task = merge_day_partials(partials.join(days, "date"), ("task_id", "session_id"))
    wanted = parsed.drop("start_date", "end_date").withColumnRenamed("sex", "t_sex")
    matched = join_users(per_task, users, cities).join(wanted, "task_id").where(_task_matches())
    return task_rows(parsed, matched)


def task_rows(parsed: DataFrame, matched: DataFrame) -> DataFrame:
    """A row for every task of :func:`parse_tasks` with the session count and bucket shares of its ``matched`` sessions."""
    aggs = [F.count(F.lit(1)).alias("session_count")]
    for metric, buckets in FINE_SPEC:
        for name, lo_, hi_ in buckets:
            aggs.append(F.count_if(_in_bucket(F.col(metric), lo_, hi_)).alias(f"{metric}_{name}"))
    counts = matched.groupBy("task_id").agg(*aggs)
    stats = parsed.select("task_id").join(counts, "task_id", "left")
    total = F.coalesce(F.col("session_count"), F.lit(0).cast("bigint"))
    out = [F.col("task_id"), total.alias("session_count")]
    for metric, buckets in FINE_SPEC:
        for name, _, _ in buckets:
            out.append(half_up_share(F.col(f"{metric}_{name}"), total).alias(f"{metric}_{name}_ratio"))
    return stats.select(*out)


def session_report(actions: DataFrame, users: DataFrame, cities: DataFrame, params: TaskParams) -> dict[str, DataFrame]:
    """The task's filtered sessions, fine histogram with shares, and totals.

    The filtered sessions are computed once and written to the shared folder
    (:func:`materialize`); the other outputs read that table instead of
    re-running the scan, aggregate and join.
    """
    from .materialize import materialize

    sessions = materialize(filtered_sessions(actions, users, cities, params), "session-report")
    return {
        "sessions": sessions,
        "ratios": bucket_counts(sessions, FINE_SPEC, with_share=True),
        "totals": sessions.agg(F.count(F.lit(1)).alias("session_count"),
                               F.sum("step_length").alias("total_actions")),
    }