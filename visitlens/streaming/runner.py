"""Running a streaming query into a parquet table.

Every micro-batch's result goes to its own folder ``batch_id=<n>`` and is
written with ``overwrite``: when a batch is replayed after a failure (the
checkpoint records which batches committed), its folder is replaced, so the
table ends up exactly-once even though ``foreachBatch`` is at-least-once.
Checkpoint and output live under the session's shared checkpoint folder.
"""

from __future__ import annotations

import os
import threading
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, StructType

from ..session import fresh_path
from ..sources.files import _file_system, path_exists

BatchFn = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class StreamTable:
    """Where a streaming job keeps its state and its output."""

    checkpoint: str
    output: str

    @property
    def snapshots(self) -> str:
        return self.output.rstrip("/") + "-snapshots"

    @classmethod
    def fresh(cls, spark: SparkSession, label: str) -> "StreamTable":
        base = fresh_path(spark, label)
        return cls(os.path.join(base, "checkpoint"), os.path.join(base, "data"))


class LateRows(StreamingQueryListener):
    """Adds up the rows that each run dropped by its watermark; a query itself remembers its last updates only."""

    def __init__(self):
        self.dropped: Counter = Counter()
        self._ended: dict[str, threading.Event] = {}

    def ended(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        self.dropped[str(event.progress.runId)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event):
        self.ended(event.runId).set()


#: Seconds that a stopped query's last events may take to arrive.
EVENTS_S = 120


def start_to_table(stream: DataFrame, table: StreamTable, batch_fn: BatchFn,
                   output_mode: str = "append", trigger: dict | None = None,
                   query_name: str | None = None):
    """Start ``stream`` with ``foreachBatch``: ``batch_fn(batch_df, batch_id)``
    is written to ``table.output/batch_id=<id>``. Returns the running query.

    ``batch_fn`` must stay lazy: the write is the one action on the
    micro-batch (a second action would re-run the batch's stateful work)."""

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        result = batch_fn(batch_df, batch_id)
        result.write.mode("overwrite").parquet(os.path.join(table.output, f"batch_id={batch_id}"))

    writer = (stream.writeStream.outputMode(output_mode)
              .option("checkpointLocation", table.checkpoint)
              .foreachBatch(write_batch)
              .trigger(**(trigger or {"availableNow": True})))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def run_available(stream: DataFrame, table: StreamTable, batch_fn: BatchFn,
                  output_mode: str = "append", report: dict | None = None) -> None:
    """Process everything available now (in as many micro-batches as the
    source's rate limit makes), then stop. Restarting with the same ``table``
    resumes from the checkpoint. ``report`` receives ``late_rows``: how many (partially
    aggregated) rows came after the watermark had passed their window and were dropped."""
    streams, late = stream.sparkSession.streams, LateRows()
    if report is not None:
        streams.addListener(late)
    try:
        query = start_to_table(stream, table, batch_fn, output_mode)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"streaming query failed: {query.exception()}")
        if report is not None:
            if not late.ended(query.runId).wait(EVENTS_S):  # events come in order: the last one tells that all are in
                raise RuntimeError("the count of late rows did not arrive")
            report["late_rows"] = late.dropped[str(query.runId)]
    finally:
        if report is not None:
            streams.removeListener(late)


def read_table(spark: SparkSession, table: StreamTable, schema) -> DataFrame:
    """All batches written so far, with ``batch_id`` as a bigint column."""
    full = StructType(list(schema.fields))
    if "batch_id" not in full.fieldNames():
        full = full.add("batch_id", LongType())
    if not path_exists(spark, table.output):  # no batch written yet; any other failure is an error
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).option("basePath", table.output).parquet(table.output)
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def output_schema(spark: SparkSession, stream: DataFrame, batch_fn: BatchFn):
    """Schema of ``batch_fn``'s result, found by planning it on an empty batch."""
    empty = spark.createDataFrame([], stream.schema)
    return batch_fn(empty, 0).schema


def run_or_start(spark: SparkSession, stream: DataFrame, table: StreamTable, batch_fn: BatchFn,
                 output_mode: str, trigger: dict | None, report: dict | None = None):
    """``trigger=None``: process what is available, stop, and return the
    result table as a DataFrame. Otherwise start a long-running query with
    that trigger (e.g. ``{"processingTime": "5 seconds"}``) and return its
    handle; read the table later with :func:`read_table`."""
    if trigger is None:
        run_available(stream, table, batch_fn, output_mode, report)
        return read_table(spark, table, output_schema(spark, stream, batch_fn))
    return start_to_table(stream, table, batch_fn, output_mode, trigger)


def compact_totals(spark: SparkSession, table: StreamTable, schema, key: str, value: str) -> int:
    """Fold a running total's per-batch updates into one snapshot, and return its last batch.

    The snapshot is written to a folder of its own before it counts, so a failure leaves the former one in
    force. Readers take the newest snapshot and the batches after it; folders of folded
    batches are no longer read and may be expired by the store.
    """
    totals = latest_totals(spark, table, schema, key, value)
    last = read_table(spark, table, schema).agg(F.max("batch_id")).first()[0]
    if last is not None:
        totals.write.mode("overwrite").parquet(os.path.join(table.snapshots, f"upto={last}"))
    return -1 if last is None else last


def _newest_snapshot(spark: SparkSession, table: StreamTable) -> int:
    """The last batch that a finished snapshot holds, or -1. Only folder names are read."""
    if not path_exists(spark, table.snapshots):
        return -1
    fs, hadoop = _file_system(spark, table.snapshots)
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    done = [int(n.removeprefix("upto=")) for n in names
            if n.startswith("upto=") and path_exists(spark, os.path.join(table.snapshots, n, "_SUCCESS"))]
    return max(done, default=-1)


def latest_totals(spark: SparkSession, table: StreamTable, schema, key: str, value: str) -> DataFrame:
    """Latest ``value`` per ``key``: the newest snapshot and the batches after it."""
    upto = _newest_snapshot(spark, table)
    tail = read_table(spark, table, schema).where(F.col("batch_id") > upto).select(key, value, "batch_id")
    if upto >= 0:
        known = spark.read.parquet(os.path.join(table.snapshots, f"upto={upto}"))
        tail = tail.unionByName(known.withColumn("batch_id", F.lit(upto).cast("bigint")))
    return tail.groupBy(key).agg(F.max_by(value, "batch_id").alias(value))
