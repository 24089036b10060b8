"""Sessions without gathered sets, for sessions of any size.

``session_agg`` keeps a session's distinct keywords and categories in its row; a crawler's session would be one row of millions of values.
Here the values stay rows of their own, distinct by ``(session_id, kind, value)``, and a task's filters on them are flags that
the session's aggregate computes. No row grows with its session, and one session's rows are pre-aggregated by many tasks.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import whole_seconds_between
from ..functions.params import TaskParams
from .sessions import _is_wall_clock, date_range, join_users, task_predicate

KEYWORD, CATEGORY = "keyword", "category"


def _values() -> Column:
    """An action's values as ``(kind, value)``: its non-empty keyword and its clicked category."""
    word, category = F.col("search_keyword"), F.col("click_category_id").cast("string")
    pairs = F.array(F.struct(F.lit(KEYWORD).alias("kind"), F.when(word != "", word).alias("value")),
                    F.struct(F.lit(CATEGORY).alias("kind"), category.alias("value")))
    return F.filter(pairs, lambda p: p["value"].isNotNull())


def session_values(actions: DataFrame) -> DataFrame:
    """Distinct ``(session_id, kind, value)``: the elements of the sets of ``session_agg``, one a row."""
    return actions.select("session_id", F.inline(_values())).distinct()


def session_value_counts(actions: DataFrame) -> DataFrame:
    """``(session_id, n_keywords, n_categories)`` for every session: distinct values first, then their number."""
    counts = session_values(actions).groupBy("session_id").agg(
        F.count_if(F.col("kind") == KEYWORD).alias("n_keywords"), F.count_if(F.col("kind") == CATEGORY).alias("n_categories"))
    sessions = actions.select("session_id").distinct()
    return sessions.join(counts, "session_id", "left").na.fill(0, ["n_keywords", "n_categories"])


def sessions_with(sessions: DataFrame, values: DataFrame, kind: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``sessions`` that have one of the ``wanted (value)`` of that kind, by semi-joins; ``wanted`` may be a large table."""
    found = values.where(F.col("kind") == kind).join(wanted.select(F.col("value").cast("string")), "value", "left_semi")
    return sessions.join(found.select("session_id"), "session_id", "left_semi")


def session_facts(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row of fixed size per session: ``session_id, user_id, step_length, visit_length, keyword_hit, category_hit``.
    A hit is true if the session has one of the task's values, or the task names none."""
    def hit(column: str, wanted: tuple[str, ...] | None) -> Column:
        if wanted is None:
            return F.lit(True)
        return F.coalesce(F.bool_or(F.col(column).cast("string").isin([w for w in wanted if w])), F.lit(False))

    return actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"), F.count(F.lit(1)).alias("step_length"),
        whole_seconds_between(F.min("action_time"), F.max("action_time"), _is_wall_clock(actions, "action_time")).alias("visit_length"),
        hit("search_keyword", params and params.keywords).alias("keyword_hit"),
        hit("click_category_id", params and params.category_ids).alias("category_hit"))


def filtered_facts(actions: DataFrame, users: DataFrame, cities: DataFrame, params: TaskParams) -> DataFrame:
    """``filtered_sessions`` without the sets: date range, fixed-size session rows, user join, task filter."""
    facts = session_facts(date_range(actions, params.start_date, params.end_date), params).where("keyword_hit and category_hit")
    of_user = task_predicate(replace(params, keywords=None, category_ids=None))
    return join_users(facts.drop("keyword_hit", "category_hit"), users, cities).where(of_user)
