"""Keyed state with a function of the caller's: ``(key, batch's rows, state or None) -> new state or None``.

The function sees a key's rows of one micro-batch and the key's state so far. What it returns becomes the state; None removes the key.
A key that gets no rows for ``timeout`` is handed to the function once more, with no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .runner import StreamTable, read_table, run_available, start_to_table

StateFn = Callable[[tuple, Iterator[pd.DataFrame], tuple | None], tuple | None]


def keyed_state(spark: SparkSession, rows: DataFrame, keys: list[str], fn: StateFn, state_schema: StructType, table: StreamTable,
                timeout_ms: int | None = None, trigger: dict | None = None):
    """Run ``fn`` over the stream ``rows``, keyed by ``keys``.

    Every batch writes the states it changed and, flagged ``is_removed``, the keys it removed. A bounded run (``trigger=None``)
    returns ``(*keys, *state)`` of the keys that are there; it takes no timeout, for which a job must wait. A key's rows of one batch go through one task as an iterator of
    bounded frames; the source's rate limit bounds them. State is restored from the checkpoint on restart.
    """
    if timeout_ms is not None and trigger is None:
        raise ValueError("a timeout needs a long-running job (trigger)")
    key_schema = StructType([rows.schema[k] for k in keys])
    out_schema = StructType(key_schema.fields + state_schema.fields).add("is_removed", BooleanType())
    names, timed = out_schema.fieldNames(), timeout_ms is not None

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        new = fn(key, iter(()) if state.hasTimedOut else frames, tuple(state.get) if state.exists else None)
        if new is not None:
            state.update(tuple(new))
            if timed:
                state.setTimeoutDuration(timeout_ms)
            yield pd.DataFrame([(*key, *new, False)], columns=names)
        elif state.exists:
            state.remove()
            yield pd.DataFrame([(*key, *[None] * len(state_schema), True)], columns=names)

    changed = rows.groupBy(*keys).applyInPandasWithState(
        step, out_schema, state_schema, "update", GroupStateTimeout.ProcessingTimeTimeout if timed else GroupStateTimeout.NoTimeout)
    if trigger is not None:
        return start_to_table(changed, table, lambda batch, _id: batch, "update", trigger)
    run_available(changed, table, lambda batch, _id: batch, "update")
    return current_states(read_table(spark, table, out_schema), keys)


def current_states(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The newest state of every key that was not removed since."""
    state = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*state), "batch_id").alias("s"))
    return newest.where(~F.col("s.is_removed")).select(*keys, *[F.col(f"s.{c}").alias(c) for c in state if c != "is_removed"])


GAPS = StructType([StructField(c, LongType()) for c in ("n_events", "first_us", "last_us", "longest_gap_us")])


def longest_gaps(key: tuple, frames: Iterator[pd.DataFrame], state: tuple | None) -> tuple | None:
    """State function: number of a key's events, the first and the last, and the longest time without one, from their ``us`` times.

    Events of later batches must not be older than those before. Removes a key that has been silent for the timeout."""
    times = [frame["us"].to_numpy(np.int64) for frame in frames]
    if not times:
        return None
    us = np.sort(np.concatenate(times))
    n, first, last, longest = state or (0, int(us[0]), int(us[0]), 0)
    gaps = np.diff(us, prepend=last)
    return n + len(us), min(first, int(us[0])), max(last, int(us[-1])), max(longest, int(gaps.max()))
