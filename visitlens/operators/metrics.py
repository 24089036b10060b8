"""Side metrics of a query, gathered while it runs (no second pass)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observe_counts(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Attach row counts per condition (e.g. rows whose time did not parse).

    The counts are computed by the same job that consumes the returned
    DataFrame; ``observation.get`` returns them (one small row reaches the
    driver) once that job has run. On a stream, the values appear in each
    batch's progress under ``observedMetrics``.
    """
    observation = Observation(name)
    exprs = [F.count_if(cond).alias(key) for key, cond in conditions.items()]
    return df.observe(observation, *exprs), observation
