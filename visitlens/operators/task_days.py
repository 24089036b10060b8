"""The days that a table of tasks asks for prune the partitions of the actions.

A single task's range is a literal and reaches the scan. The ranges of a task table are known only at run time: their
distinct days are joined to a table written by day (``layout.save_by_day``), and dynamic partition pruning reads
only the folders of those days. The days broadcast are at most those between the data's first and last day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .materialize import materialize
from .sessions import parse_tasks, session_task_stats

#: More days than this (a thousand years) are joined without a broadcast.
MAX_DAYS = 366_000


def wanted_days(actions: DataFrame, tasks: DataFrame) -> DataFrame:
    """Distinct days (``date``, text) in the ranges of the tasks, within the data's. An open end is the data's."""
    first, last = (actions.agg(f("date")).scalar() for f in (F.min, F.max))
    lo = F.greatest("start_date", first).cast("date")
    hi = F.least("end_date", last).cast("date")
    ranges = parse_tasks(tasks).select(lo.alias("lo"), hi.alias("hi")).where("lo <= hi").distinct()
    return ranges.select(F.explode(F.sequence("lo", "hi")).alias("day")).select(F.col("day").cast("string").alias("date")).distinct()


def prune_days(actions: DataFrame, tasks: DataFrame) -> DataFrame:
    """The rows of ``actions`` on a day that some task asks for.

    The first and last day wanted are literals for the scan; between them the days' table prunes."""
    days = materialize(wanted_days(actions, tasks), "task-days")
    n, first, last = days.agg(F.count(F.lit(1)), F.min("date"), F.max("date")).first()
    if not n:
        return actions.limit(0)
    days = days.where(F.col("date").between(first, last))
    return actions.join(F.broadcast(days) if n <= MAX_DAYS else days, "date", "left_semi").select(*actions.columns)


def task_stats_by_day(actions: DataFrame, users: DataFrame, cities: DataFrame, tasks: DataFrame) -> DataFrame:
    """The rows of :func:`visitlens.operators.sessions.session_task_stats`, reading only the tasks' days of actions written by day."""
    return session_task_stats(prune_days(actions, tasks), users, cities, tasks)
