"""Streaming jobs: restart from checkpoint, per-batch counts, late data,
short lines, and stream = batch twin over closed windows."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from conftest import explain_text, SF_SMALL, rows
from visitlens.operators import windows
from visitlens.sources import parquet_table_stream, text_dir_stream
from visitlens.streaming import jobs
from visitlens.streaming.runner import StreamTable


def _write(folder, name, text, mtime):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (mtime, mtime))


def test_running_count_survives_restart(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    table = StreamTable.fresh(spark, "test-running")
    _write(src, "f1.txt", "x y\nx\n", 1_000_000)
    got = dict(rows(jobs.running_word_count(spark, text_dir_stream(spark, src), table)))
    assert got == {"x": 2, "y": 1}
    _write(src, "f2.txt", "x z\n", 2_000_000)
    # a new query on the same checkpoint: state is restored, only f2 is new
    got = dict(rows(jobs.running_word_count(spark, text_dir_stream(spark, src), table)))
    assert got == {"x": 3, "y": 1, "z": 1}


def test_batch_word_count_is_per_batch(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    _write(src, "f1.txt", "x y\nx\n", 1_000_000)
    _write(src, "f2.txt", "x z\n", 2_000_000)
    out = jobs.batch_word_count(spark, text_dir_stream(spark, src, max_files_per_trigger=1),
                                StreamTable.fresh(spark, "test-batch"))
    got = sorted(rows(out, "batch_id", "word", "count"))
    assert got == [(0, "x", 2), (0, "y", 1), (1, "x", 1), (1, "z", 1)]


def test_topic_word_count_on_key_value_stream(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    _write(src, "m.txt", "a b a\nb  \n", 1_000_000)
    messages = text_dir_stream(spark, src).select(F.lit("k").alias("key"), F.col("value"))
    out = jobs.topic_word_count(spark, messages, StreamTable.fresh(spark, "test-topic"))
    assert sorted(rows(out, "word", "count")) == [("a", 2), ("b", 2)]


def _stamp(s):
    return dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=s)


def test_late_row_dropped_by_watermark(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    schema = "ts timestamp, keyword string"
    batches = [[(5, "a"), (300, "a")], [(320, "b")], [(6, "a")]]
    for i, b in enumerate(batches):
        spark.createDataFrame([(_stamp(s), k) for s, k in b], schema).coalesce(1).write.parquet(
            os.path.join(src, f"part{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    report = {}
    out = jobs.hot_search_stream(spark, stream, StreamTable.fresh(spark, "test-late"),
                                 length="60 seconds", slide="60 seconds", delay="10 seconds", report=report)
    got = sorted(rows(out.withColumn("start", F.date_format("window_start", "HH:mm:ss")),
                      "start", "keyword", "search_count", "is_open"))
    # window 00:00 holds the first row only: 00:00:06 arrived after the
    # watermark had reached 00:05:10 and was dropped, which is reported. Window 00:05 ends after
    # the final watermark: it is returned as still open.
    assert got == [("00:00:00", "a", 1, False), ("00:05:00", "a", 1, True), ("00:05:00", "b", 1, True)]
    assert report == {"late_rows": 1}


def test_late_rows_of_every_batch_are_counted(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    schema = "ts timestamp, keyword string"
    for i, b in enumerate([[(300, "a")], [(310, "b")], [(6, "a")], [(7, "c"), (8, "d")], [(320, "a")], [(330, "a")]]):
        spark.createDataFrame([(_stamp(s), k) for s, k in b], schema).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(src))
    report = {}
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")  # as after 100 more batches
    try:
        jobs.hot_search_stream(spark, stream, StreamTable.fresh(spark, "test-all-late"), length="60 seconds", slide="60 seconds",
                               delay="10 seconds", report=report)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert report == {"late_rows": 3}


def test_a_long_enough_delay_drops_nothing(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    schema = "ts timestamp, keyword string"
    data = [(s, f"k{s % 4}") for s in range(0, 600, 7)]
    for i, part in enumerate((data[40:], data[:20], data[20:40])):  # files out of order, one batch each
        spark.createDataFrame([(_stamp(s), k) for s, k in part], schema).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(src))
    report = {}
    out = jobs.hot_search_stream(spark, stream, StreamTable.fresh(spark, "test-delay"), "60 seconds", "10 seconds",
                                 delay="1 hour", report=report)
    whole = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    assert sorted(rows(out.drop("is_open"))) == sorted(rows(windows.hot_search(whole, "60 seconds", "10 seconds")))
    assert report == {"late_rows": 0}


def test_short_lines_are_skipped(spark):
    lines = spark.createDataFrame([("u1", _stamp(1)), ("u1 ", _stamp(1)), ("u1 lamp ", _stamp(2)), ("u1 lamp light  ", _stamp(3))],
                                  "value string, ts timestamp")
    assert rows(windows.searches_from_lines(lines), "keyword") == [("lamp",), ("lamp",)]
    assert rows(windows.goods_from_lines(lines), "category", "product") == [("light", "lamp")]


def test_stream_equals_batch_twin(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    batch = windows.hot_goods(windows.goods_from_events(events), "6 hours", "1 hour")
    stream_events = parquet_table_stream(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    streamed = jobs.hot_goods_stream(spark, windows.goods_from_events(stream_events),
                                     StreamTable.fresh(spark, "test-twin"), "6 hours", "1 hour", "1 hour")
    def norm(df):
        return sorted(rows(df.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), "category",
                                     "product", "click_count", F.col("rank").cast("long"))))

    assert norm(streamed) == norm(batch)
    assert 0 < streamed.where("is_open").count() < streamed.count()


def test_long_running_trigger_returns_a_query(spark):
    from visitlens.streaming.runner import read_table

    src = tempfile.mkdtemp(prefix="stream-src-")
    _write(src, "f1.txt", "x y\nx\n", 1_000_000)
    table = StreamTable.fresh(spark, "test-trigger")
    query = jobs.batch_word_count(spark, text_dir_stream(spark, src), table,
                                  trigger={"processingTime": jobs.WORD_COUNT_INTERVAL})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    out = read_table(spark, table, spark.createDataFrame([], "word string, count long").schema)
    assert sorted(rows(out, "word", "count")) == [("x", 2), ("y", 1)]


def test_running_count_complete_mode_matches_update_mode(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    _write(src, "f1.txt", "x y\nx\n", 1_000_000)
    _write(src, "f2.txt", "x z\n", 2_000_000)
    got = {}
    for mode in ("update", "complete"):
        stream = text_dir_stream(spark, src, max_files_per_trigger=1)
        got[mode] = dict(rows(jobs.running_word_count(spark, stream, StreamTable.fresh(spark, f"test-{mode}"),
                                                      output_mode=mode)))
    assert got["update"] == got["complete"] == {"x": 3, "y": 1, "z": 1}


def test_parquet_folder_stream_picks_up_new_part_files(spark):
    folder = tempfile.mkdtemp(prefix="stream-parquet-") + "/events"
    spark.createDataFrame([(_stamp(1), "a b")], "ts timestamp, value string").write.parquet(folder)
    from visitlens.sources import parquet_stream

    table = StreamTable.fresh(spark, "test-parquet-folder")
    first = jobs.batch_word_count(spark, parquet_stream(spark, folder), table)
    assert sorted(rows(first, "word", "count")) == [("a", 1), ("b", 1)]
    spark.createDataFrame([(_stamp(2), "a")], "ts timestamp, value string").write.mode("append").parquet(folder)
    second = jobs.batch_word_count(spark, parquet_stream(spark, folder), table)
    assert sorted(rows(second, "batch_id", "word", "count")) == [(0, "a", 1), (0, "b", 1), (1, "a", 1)]


def test_late_row_is_counted_in_progress(spark):
    from visitlens.streaming.runner import start_to_table

    src = tempfile.mkdtemp(prefix="stream-src-")
    schema = "ts timestamp, keyword string"
    for i, b in enumerate([[(5, "a"), (300, "a")], [(320, "b")], [(6, "a")]]):
        spark.createDataFrame([(_stamp(s), k) for s, k in b], schema).coalesce(1).write.parquet(
            os.path.join(src, f"part{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    counts = jobs.windowed_counts(stream, ["keyword"], "search_count", "60 seconds", "60 seconds", "10 seconds")
    query = start_to_table(counts, StreamTable.fresh(spark, "test-dropped"), lambda b, _i: b, "append")
    query.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


STREAM_KEYS = ["stream_hot_search", "stream_hot_goods", "stream_running_count", "stream_batch_word_count",
               "stream_topic_word_count"]


def test_streams_read_a_folder_of_part_files_and_a_single_file_alike(spark):
    from visitlens.plans.queries import QUERIES

    folder = tempfile.mkdtemp(prefix="stream-tables-")
    for name in ("events", "documents", "conversations"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    for key in STREAM_KEYS:
        parts, single = rows(QUERIES[key](spark, folder)), rows(QUERIES[key](spark, SF_SMALL))
        assert parts and sorted(parts) == sorted(single), key


def test_a_missing_table_raises(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        parquet_table_stream(spark, tempfile.mkdtemp(prefix="stream-none-"), "events")


def test_unreadable_output_is_an_error_and_none_is_empty(spark):
    import pytest

    from visitlens.streaming.runner import read_table

    table = StreamTable.fresh(spark, "test-none")
    schema = spark.createDataFrame([], "word string, count long").schema
    assert read_table(spark, table, schema).count() == 0
    spark.createDataFrame([("x",)], "a string").write.text(table.output + "/batch_id=0")
    with pytest.raises(Exception):
        read_table(spark, table, schema).collect()


def test_running_count_reads_snapshot_and_tail(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    table = StreamTable.fresh(spark, "test-compact")
    schema = spark.createDataFrame([], "word string, count long").schema
    _write(src, "f1.txt", "x y\nx\n", 1_000_000)
    jobs.running_word_count(spark, text_dir_stream(spark, src), table)
    upto = jobs.compact_running_count(spark, table)
    _write(src, "f2.txt", "x z\n", 2_000_000)
    out = jobs.running_word_count(spark, text_dir_stream(spark, src), table)
    assert dict(rows(out)) == {"x": 3, "y": 1, "z": 1}
    # the folded batch is not read any more
    plan = explain_text(jobs.current_totals(spark, table, schema), "formatted")
    assert f"upto={upto}" in plan and "batch_id" in plan
    assert jobs.compact_running_count(spark, table) > upto
    assert dict(rows(jobs.current_totals(spark, table, schema))) == {"x": 3, "y": 1, "z": 1}
