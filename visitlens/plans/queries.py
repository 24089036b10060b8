"""The registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
whole given tables. Result columns are plain (bigint, int, double, string)
so they compare one-to-one with the DuckDB oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .. import functions as fn
from ..functions.params import TaskParams
from ..operators import relational as rel
from ..operators import sessions as ses
from ..operators import layout, session_values, task_days, task_index, text, windows
from ..operators.partitioning import spread
from ..session import fresh_path
from ..sources import parquet_table_stream, parse_delimited, read_lines, read_table, text_dir_stream, write_lines
from ..streaming import jobs, panes, state, versions
from ..streaming.runner import StreamTable

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (shared with the oracle SQL).
SESSION_RANGE = ("2024-01-03", "2024-01-20")
FILTER_TASK_JSON = ("{'startDate':['2024-01-03'],'endDate':['2024-01-20'],"
                    "'startAge':['12'],'endAge':['47'],'sex':['female'],"
                    "'categoryIds':['1,5,9,13,17,21,25,29,33,37,41,45,49,53,57,61,65,69,73,77,81,85,89,93,97']}")
FILTER_TASK = TaskParams.from_json(FILTER_TASK_JSON, task_id=1)
STAT_TASK_JSONS = [
    FILTER_TASK_JSON,
    "{'startAge':['20'],'endAge':['40'],'cities':['NATION_1,NATION_3,NATION_5,NATION_7,NATION_11,NATION_13,NATION_17'],'keywords':['kw1,kw3']}",
    "{'startDate':['2024-01-10'],'endDate':['2024-01-12'],'professionals':['BUILDING'],'sex':['male']}",
    "{'startDate':['2023-01-01'],'endDate':['2023-01-31']}",
]
FINE_GRAIN = "week"
COARSE_GRAIN = "month"
HOT_LENGTH, HOT_SLIDE, HOT_DELAY = "6 hours", "1 hour", "1 hour"
TIME_TEXT_BOUND = "12:00:00"
LINE_NEEDLE = "g"
EVEN_COLUMN = "l_linenumber"
AGE_LIMIT = 16
TOP_WORDS = 3
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def _actions(spark, d, grain="day") -> DataFrame:
    return ses.actions_from_events(_t(spark, d, "events"), grain)


def _users(spark, d) -> tuple[DataFrame, DataFrame]:
    """The user table and its cities."""
    return ses.users_from_customer(_t(spark, d, "customer")), ses.cities_from_nation(_t(spark, d, "nation"))


def _doc_lines(spark, d) -> DataFrame:
    # Spread whole documents (few rows) rather than their lines (many rows).
    return fn.document_lines(spread(_t(spark, d, "documents").select("text")))


def _text_folder(spark, d) -> str:
    """The corpus as a folder of text files in the shared folder."""
    return write_lines(_doc_lines(spark, d), fresh_path(spark, "text-files"))


def _ts_text(c) -> F.Column:
    return F.date_format(c, TS_TEXT)


# -- text ---------------------------------------------------------------------

def q_word_count(spark, d):
    return text.word_count(_doc_lines(spark, d))


def q_text_file_word_count(spark, d):
    """Word count of a folder of text files, written from the corpus's lines and read as files."""
    return text.word_count(read_lines(spark, _text_folder(spark, d), "\n"))


def q_top_words(spark, d):
    counts = text.word_count(_doc_lines(spark, d))
    return rel.top_n(counts, [F.col("count").desc(), F.col("word")], TOP_WORDS)


def q_line_count_containing(spark, d):
    return text.line_count_containing(_doc_lines(spark, d), LINE_NEEDLE)


# -- relational ----------------------------------------------------------------

DELIMITED_SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()),
                               StructField("nation", IntegerType())])


def q_parse_delimited(spark, d):
    cust = _t(spark, d, "customer")
    lines = cust.select(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("value"))
    return parse_delimited(lines, DELIMITED_SCHEMA, ",")


def q_map_double(spark, d):
    return rel.map_double(_t(spark, d, "lineitem"), "l_quantity", "quantity_x2",
                          keep=["l_orderkey", "l_linenumber"])


def q_filter_even(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rel.filter_even(li, EVEN_COLUMN)


FILTER_ORDER_SQL = "select * from {students} where age <= :max_age order by id"


def q_filter_order(spark, d):
    students = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                               F.col("c_nationkey").alias("age"))
    return rel.sql(spark, FILTER_ORDER_SQL, {"students": students}, args={"max_age": AGE_LIMIT})


INNER_JOIN_SQL = ("select st.c_custkey as id, st.c_name as name, sc.o_orderkey as order_key, "
                  "sc.o_totalprice as score from {customer} st, {orders} sc where st.c_custkey = sc.o_custkey")


def q_inner_join_sql(spark, d):
    return rel.sql(spark, INNER_JOIN_SQL, {"customer": _t(spark, d, "customer"),
                                           "orders": _t(spark, d, "orders")})


def q_secondary_sort(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = rel.secondary_sort(orders, [("o_orderdate", True), ("o_totalprice", True)], ["o_orderkey"])
    return out.withColumn("o_orderdate", _ts_text("o_orderdate"))


def q_group_top_n(spark, d):
    orders = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    top = rel.group_top_n(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


def q_group_collect(spark, d):
    return rel.group_collect(_t(spark, d, "events"), "user_id", "event_id")


def q_count_by_key(spark, d):
    return rel.count_by_key(_t(spark, d, "events"), "event_type")


def q_count_by_column(spark, d):
    # the fourth column holds NULLs (events that are no search)
    acts = _actions(spark, d).select("date", "user_id", "session_id", "search_keyword")
    return rel.count_by_position(acts, 3)


# -- sessions ------------------------------------------------------------------

def q_date_range_scan(spark, d):
    acts = ses.date_range(_actions(spark, d), *SESSION_RANGE)
    # Nullable ids as text: NULL stays NULL and values compare the same in any
    # client (a nullable bigint becomes a float in pandas).
    return acts.withColumns({"action_time": _ts_text("action_time"),
                             "click_category_id": F.col("click_category_id").cast("string"),
                             "click_product_id": F.col("click_product_id").cast("string")})


def q_session_agg(spark, d):
    return ses.sessions_as_text(ses.session_agg(_actions(spark, d)))


def q_session_user_join(spark, d):
    sessions = ses.session_agg(_actions(spark, d))
    return ses.sessions_as_text(ses.session_user_join(sessions, *_users(spark, d)))


def q_session_filter(spark, d):
    return ses.sessions_as_text(ses.filtered_sessions(_actions(spark, d, FINE_GRAIN), *_users(spark, d),
                                                      FILTER_TASK))


def q_session_totals(spark, d):
    return ses.session_totals(ses.session_agg(_actions(spark, d)), _users(spark, d)[0])


def q_session_buckets_coarse(spark, d):
    return ses.bucket_counts(ses.session_agg(_actions(spark, d, COARSE_GRAIN)), ses.COARSE_SPEC)


def q_session_buckets_fine(spark, d):
    filtered = ses.filtered_sessions(_actions(spark, d, FINE_GRAIN), *_users(spark, d), FILTER_TASK)
    return ses.bucket_counts(filtered, ses.FINE_SPEC)


def q_session_bucket_ratio(spark, d):
    filtered = ses.filtered_sessions(_actions(spark, d, FINE_GRAIN), *_users(spark, d), FILTER_TASK)
    return ses.bucket_counts(filtered, ses.FINE_SPEC, with_share=True)


def q_session_task_stats(spark, d):
    tasks = spark.createDataFrame(list(enumerate(STAT_TASK_JSONS, 1)), "task_id long, params string")
    return ses.session_task_stats(_actions(spark, d, FINE_GRAIN), *_users(spark, d), tasks)


def q_session_kv(spark, d):
    """Sessions encoded as ``k=v|...`` records, one field rewritten, fields read back."""
    joined = ses.session_user_join(ses.session_agg(_actions(spark, d)), *_users(spark, d))
    keywords = fn.trim_comma(F.concat(F.array_join("search_keywords", ","), F.lit(",")))
    categories = fn.trim_comma(F.concat(F.array_join(F.col("click_category_ids").cast("array<string>"), ","),
                                        F.lit(",")))
    record = fn.kv_record([
        ("session_id", F.col("session_id")), ("search_keywords", keywords),
        ("click_category_ids", categories), ("step_length", F.col("step_length")),
        ("visit_length", F.col("visit_length")), ("age", F.col("age")),
        ("professional", F.col("professional")), ("city", F.col("city")), ("sex", F.col("sex")),
    ])
    rec = joined.select("session_id", "user_id", "step_length", record.alias("record"))
    updated = rec.select(
        "session_id", "user_id",
        fn.kv_set(F.col("record"), "step_length", fn.pad_two(F.col("step_length").cast("string"))).alias("record"))
    rec = F.col("record")
    decoded = updated.select(
        "session_id", "user_id", "record",
        fn.kv_get(rec, "search_keywords").alias("search_keywords"),
        fn.kv_get(rec, "click_category_ids").alias("click_category_ids"),
        fn.kv_get(rec, "step_length").alias("step_length"),
        fn.kv_get(rec, "visit_length").cast("bigint").alias("visit_length"),
        fn.kv_get(rec, "city").alias("city"),
        fn.kv_get(rec, "missing").alias("missing"),
    )
    return decoded.withColumns({"no_keywords": fn.is_empty(F.col("search_keywords")),
                                "has_categories": fn.is_not_empty(F.col("click_category_ids"))})


def q_time_normalise(spark, d):
    """Event times as unpadded-hour text, then parsed, compared, differenced
    and re-formatted with the date helpers."""
    ev = _t(spark, d, "events").select("event_id", F.date_format("ts", fn.dates.FORMAT_TIME_UNPADDED).alias("t"))
    t = F.col("t")
    parsed = fn.parse_time(t)
    day = F.get(F.split(t, " "), 0)
    noon = F.concat(day, F.lit(" " + TIME_TEXT_BOUND))
    midnight = F.concat(day, F.lit(" 0:00:00"))
    return ev.select(
        "event_id", t.alias("action_time"),
        # epoch of the wall-clock text read as UTC, whatever the session zone
        F.unix_seconds(fn.wall_clock_as_instant(parsed.cast("timestamp_ntz"), _tz(spark))).alias("epoch_seconds"),
        fn.format_time(parsed).alias("time_text"),
        fn.format_date(parsed).alias("date_text"),
        fn.date_hour(t).alias("date_hour"),
        fn.yesterday(parsed.cast("date")).alias("day_before"),
        fn.today(parsed.cast("date")).alias("same_day"),
        fn.before(t, noon).alias("before_noon"),
        fn.after(t, noon).alias("after_noon"),
        fn.minus_seconds(t, midnight).alias("seconds_of_day"),
    )


# -- windows (batch twins) -------------------------------------------------------

def _flat_text(df: DataFrame) -> DataFrame:
    return df.withColumns({"window_start": _ts_text("window_start"), "window_end": _ts_text("window_end"),
                           "rank": F.col("rank").cast("bigint")})


def q_hot_search(spark, d):
    return _flat_text(windows.hot_search(windows.searches_from_events(_t(spark, d, "events")),
                                         HOT_LENGTH, HOT_SLIDE))


def q_hot_goods(spark, d):
    return _flat_text(windows.hot_goods(windows.goods_from_events(_t(spark, d, "events")),
                                        HOT_LENGTH, HOT_SLIDE))


def event_lines(events: DataFrame) -> DataFrame:
    """``(ts, value)``: every event as a ``user product category`` line; some lines lack fields, some end in spaces."""
    k = F.get_json_object("props", "$.k")
    e = F.col("event_id")
    line = (F.when(e % 11 == 0, F.col("user_id").cast("string"))
            .when(e % 7 == 0, F.concat_ws(" ", F.col("user_id"), k, F.lit("")))
            .when(e % 5 == 0, F.concat_ws(" ", F.col("user_id"), k, F.col("event_type"), F.lit(""), F.lit("")))
            .otherwise(F.concat_ws(" ", F.col("user_id"), k, F.col("event_type"))))
    return events.select("ts", line.alias("value"))


def q_hot_goods_lines(spark, d):
    """``hot_goods`` from text lines: fields by position, lines that are too short are skipped."""
    return _flat_text(windows.hot_goods(windows.goods_from_lines(event_lines(_t(spark, d, "events"))), HOT_LENGTH, HOT_SLIDE))


# -- streaming -------------------------------------------------------------------

def _tz(spark) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


def _event_stream(spark, d) -> DataFrame:
    ts = fn.wall_clock_as_instant(F.col("ts"), _tz(spark))
    return parquet_table_stream(spark, d, "events").withColumn("ts", ts)


def _stream_windows_text(spark, out: DataFrame) -> DataFrame:
    tz = _tz(spark)
    return _flat_text(out.drop("is_open").withColumns({
        "window_start": fn.instant_as_wall_clock(F.col("window_start"), tz),
        "window_end": fn.instant_as_wall_clock(F.col("window_end"), tz)}))


def q_stream_hot_search(spark, d):
    searches = windows.searches_from_events(_event_stream(spark, d))
    out = jobs.hot_search_stream(spark, searches, StreamTable.fresh(spark, "hot-search"),
                                 HOT_LENGTH, HOT_SLIDE, HOT_DELAY)
    return _stream_windows_text(spark, out)


def q_stream_hot_goods(spark, d):
    goods = windows.goods_from_events(_event_stream(spark, d))
    out = jobs.hot_goods_stream(spark, goods, StreamTable.fresh(spark, "hot-goods"),
                                HOT_LENGTH, HOT_SLIDE, HOT_DELAY)
    return _stream_windows_text(spark, out)


def _doc_stream(spark, d) -> DataFrame:
    return parquet_table_stream(spark, d, "documents").select(F.col("text").alias("value"))


def q_stream_running_count(spark, d):
    return jobs.running_word_count(spark, _doc_stream(spark, d), StreamTable.fresh(spark, "running-count"),
                                   multiline=True)


def q_stream_batch_word_count(spark, d):
    return jobs.batch_word_count(spark, _doc_stream(spark, d), StreamTable.fresh(spark, "batch-count"),
                                 multiline=True)


def q_stream_topic_word_count(spark, d):
    messages = parquet_table_stream(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("key"), F.col("text").alias("value"))
    return jobs.topic_word_count(spark, messages, StreamTable.fresh(spark, "topic-count"))


def q_stream_hot_search_panes(spark, d):
    """``stream_hot_search`` with one state update a row: pane counts, then windows over the panes."""
    searches = windows.searches_from_events(_event_stream(spark, d))
    out = panes.hot_search_panes(spark, searches, StreamTable.fresh(spark, "pane-search"), HOT_LENGTH, HOT_SLIDE, HOT_DELAY)
    return _stream_windows_text(spark, out)


def q_stream_hot_search_versions(spark, d):
    """The newest version of every window's ranking; windows need not have closed."""
    searches = windows.searches_from_events(_event_stream(spark, d))
    out = versions.hot_search_versions(spark, searches, StreamTable.fresh(spark, "search-versions"), HOT_LENGTH, HOT_SLIDE, HOT_DELAY)
    return _stream_windows_text(spark, out.drop("batch_id", "is_final"))


def q_stream_hot_goods_versions(spark, d):
    goods = windows.goods_from_events(_event_stream(spark, d))
    out = versions.hot_goods_versions(spark, goods, StreamTable.fresh(spark, "goods-versions"), HOT_LENGTH, HOT_SLIDE, HOT_DELAY)
    return _stream_windows_text(spark, out.drop("batch_id", "is_final"))


def q_stream_user_gaps(spark, d):
    """Each user's longest time without an event: a state function that is no sum."""
    rows = _event_stream(spark, d).select("user_id", F.unix_micros("ts").alias("us"))
    return state.keyed_state(spark, rows, ["user_id"], state.longest_gaps, state.GAPS, StreamTable.fresh(spark, "user-gaps"))


GATHER_SIZE = 7


def q_group_gather(spark, d):
    """Every user's event ids, gathered in chunks of bounded length."""
    chunks = rel.gather_values(_t(spark, d, "events"), "user_id", "event_id", GATHER_SIZE)
    return chunks.select("user_id", "chunk", "n", F.array_join(F.col("values").cast("array<string>"), ",").alias("event_ids"))


def q_session_task_index(spark, d):
    """``session_task_stats`` by an index of the tasks' terms."""
    tasks = spark.createDataFrame(list(enumerate(STAT_TASK_JSONS, 1)), "task_id long, params string")
    return task_index.task_stats_by_index(_actions(spark, d, FINE_GRAIN), *_users(spark, d), tasks)


def q_session_task_days(spark, d):
    """``session_task_stats`` over actions written by day, of which the tasks' days are read."""
    tasks = spark.createDataFrame(list(enumerate(STAT_TASK_JSONS, 1)), "task_id long, params string")
    return task_days.task_stats_by_day(layout.save_by_day(_actions(spark, d, FINE_GRAIN)), *_users(spark, d), tasks)


def q_session_values(spark, d):
    """The distinct keywords and categories of every session, one a row."""
    return session_values.session_values(_actions(spark, d))


def q_session_value_counts(spark, d):
    return session_values.session_value_counts(_actions(spark, d))


def q_session_filter_facts(spark, d):
    """``session_filter`` from rows of fixed size, without the sets."""
    return session_values.filtered_facts(_actions(spark, d, FINE_GRAIN), *_users(spark, d), FILTER_TASK)


TEXT_FILES_PER_BATCH = 4


def q_stream_text_folder_count(spark, d):
    """Words of a folder of text files, read as a stream in several batches and counted by arrival interval; added up over the
    intervals, whose number depends on when the files were written."""
    lines = text_dir_stream(spark, _text_folder(spark, d), TEXT_FILES_PER_BATCH, "\n", arrival=True)
    counts = jobs.arrival_word_count(spark, lines, StreamTable.fresh(spark, "arrival-count"))
    return counts.groupBy("word").agg(F.sum("count").alias("count"))


QUERIES: dict[str, QueryFn] = {
    "word_count": q_word_count,
    "text_file_word_count": q_text_file_word_count,
    "top_words": q_top_words,
    "line_count_containing": q_line_count_containing,
    "parse_delimited": q_parse_delimited,
    "map_double": q_map_double,
    "filter_even": q_filter_even,
    "filter_order": q_filter_order,
    "inner_join_sql": q_inner_join_sql,
    "secondary_sort": q_secondary_sort,
    "group_top_n": q_group_top_n,
    "group_collect": q_group_collect,
    "count_by_key": q_count_by_key,
    "count_by_column": q_count_by_column,
    "date_range_scan": q_date_range_scan,
    "session_agg": q_session_agg,
    "session_user_join": q_session_user_join,
    "session_filter": q_session_filter,
    "session_totals": q_session_totals,
    "session_buckets_coarse": q_session_buckets_coarse,
    "session_buckets_fine": q_session_buckets_fine,
    "session_bucket_ratio": q_session_bucket_ratio,
    "session_task_stats": q_session_task_stats,
    "session_kv": q_session_kv,
    "time_normalise": q_time_normalise,
    "hot_search": q_hot_search,
    "hot_goods": q_hot_goods,
    "hot_goods_lines": q_hot_goods_lines,
    "stream_hot_search": q_stream_hot_search,
    "stream_hot_goods": q_stream_hot_goods,
    "stream_running_count": q_stream_running_count,
    "stream_batch_word_count": q_stream_batch_word_count,
    "stream_topic_word_count": q_stream_topic_word_count,
    "stream_hot_search_panes": q_stream_hot_search_panes,
    "stream_hot_search_versions": q_stream_hot_search_versions,
    "stream_hot_goods_versions": q_stream_hot_goods_versions,
    "stream_user_gaps": q_stream_user_gaps,
    "group_gather": q_group_gather,
    "session_task_index": q_session_task_index,
    "session_task_days": q_session_task_days,
    "session_values": q_session_values,
    "session_value_counts": q_session_value_counts,
    "session_filter_facts": q_session_filter_facts,
    "stream_text_folder_count": q_stream_text_folder_count,
}
