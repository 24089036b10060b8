"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs in DuckDB against views named like the parquet tables and
returns the same columns as the Spark query of the same key. They are
written from the semantics, independently of the Spark plans: e.g. the date
range is a text ``BETWEEN`` here and a timestamp range there, sliding windows
are expanded with ``range`` here and by ``window()`` there.
"""

from __future__ import annotations

from dataclasses import dataclass

GATHER_SIZE = 7  # values of a chunk, as in the query

# Fixed values, written out here once more so that a wrong edge in the code shows (inclusive; None = open).
COARSE_SPEC = [
    ("visit_length", [("0s", 0, 0), ("30s", 1, 30), ("120s", 31, 120), ("300s", 121, 300), ("6000s", 301, 6000),
                      ("mt6000s", 6001, None)]),
    ("step_length", [("step10", 1, 10), ("step30", 11, 30), ("step60", 31, 60), ("mtstep60", 61, None)]),
]
FINE_SPEC = [
    ("visit_length", [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
                      ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None)]),
    ("step_length", [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]),
]
SESSION_RANGE = ("2024-01-03", "2024-01-20")


@dataclass(frozen=True)
class Task:
    """A task's conditions in SQL terms."""
    task_id: int
    start_date: str | None
    end_date: str | None
    where: str


# The registered tasks, restated.
TASKS = [
    Task(1, "2024-01-03", "2024-01-20",
         "age between 12 and 47 and sex = 'female' and list_has_any(cast(cat_list as varchar[]), "
         "['1', '5', '9', '13', '17', '21', '25', '29', '33', '37', '41', '45', '49', '53', '57', '61', '65', '69', "
         "'73', '77', '81', '85', '89', '93', '97'])"),
    Task(2, None, None,
         "age between 20 and 40 and city in ('NATION_1', 'NATION_3', 'NATION_5', 'NATION_7', 'NATION_11', 'NATION_13', 'NATION_17') "
         "and list_has_any(kw_list, ['kw1', 'kw3'])"),
    Task(3, "2024-01-10", "2024-01-12", "professional = 'BUILDING' and sex = 'male'"),
    Task(4, "2023-01-01", "2023-01-31", "true"),
]

K = "cast(json_extract_string(props, '$.k') as bigint)"
TS = "'%Y-%m-%d %H:%M:%S'"


def _period(grain: str) -> str:
    return {"day": "strftime(ts, '%Y-%m-%d')",
            "week": "strftime(date_trunc('week', ts), '%Y-%m-%d')",
            "month": "strftime(ts, '%Y-%m')"}[grain]


def actions_sql(grain: str = "day") -> str:
    return f"""select strftime(ts, '%Y-%m-%d') as date, user_id,
  cast(user_id as varchar) || '_' || {_period(grain)} as session_id,
  event_id % 10 as page_id, ts as action_time,
  case when event_type = 'view' then 'kw' || cast({K} % 10 as varchar) end as search_keyword,
  case when event_type = 'click' then {K} end as click_category_id,
  case when event_type = 'click' then event_id % 100 end as click_product_id,
  case when event_type = 'signup' then cast({K} as varchar) end as order_category_ids,
  case when event_type = 'signup' then cast(event_id % 100 as varchar) end as order_product_ids,
  case when event_type = 'purchase' then cast({K} as varchar) end as pay_category_ids,
  case when event_type = 'purchase' then cast(event_id % 100 as varchar) end as pay_product_ids
from events"""


USERS_SQL = """select c_custkey as user_id, c_name as username, c_name as name,
  cast(c_custkey % 60 as integer) as age, c_mktsegment as professional, n_name as city,
  case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
from customer join nation on c_nationkey = n_nationkey"""


def _date_where(start: str | None, end: str | None) -> str:
    conds = []
    if start is not None:
        conds.append(f"date >= '{start}'")
    if end is not None:
        conds.append(f"date <= '{end}'")
    return ("where " + " and ".join(conds)) if conds else ""


def sessions_sql(actions: str, keys: str = "session_id") -> str:
    """Session aggregate with list columns ``kw_list`` and ``cat_list``."""
    return f"""select {keys}, min(user_id) as user_id,
  coalesce(list_sort(list(distinct search_keyword) filter (where search_keyword is not null and search_keyword <> '')), []) as kw_list,
  coalesce(list_sort(list(distinct click_category_id) filter (where click_category_id is not null)), []) as cat_list,
  count(*) as step_length,
  date_diff('second', date_trunc('second', min(action_time)), date_trunc('second', max(action_time))) as visit_length
from ({actions}) a group by {keys}"""


SESSION_TEXT_COLS = """session_id, user_id, array_to_string(kw_list, ',') as search_keywords,
  array_to_string(cat_list, ',') as click_category_ids, step_length, visit_length"""


def joined_sql(p: Task | None, grain: str, start=None, end=None) -> str:
    """Sessions (list form) joined to users, optionally filtered by a task."""
    if p is not None:
        start, end = p.start_date, p.end_date
    acts = f"select * from ({actions_sql(grain)}) x {_date_where(start, end)}"
    where = f"where {p.where}" if p is not None else ""
    return f"""select s.session_id, s.kw_list, s.cat_list, s.step_length, s.visit_length,
  u.age, u.professional, u.city, u.sex, s.user_id
from ({sessions_sql(acts)}) s join ({USERS_SQL}) u on s.user_id = u.user_id {where}"""


JOINED_TEXT_COLS = """session_id, array_to_string(kw_list, ',') as search_keywords,
  array_to_string(cat_list, ',') as click_category_ids, step_length, visit_length,
  age, professional, city, sex, user_id"""


def _bucket_cond(metric: str, lo: int, hi: int | None) -> str:
    return f"{metric} >= {lo}" if hi is None else f"{metric} between {lo} and {hi}"


def _share(n: str, total: str) -> str:
    return f"case when {total} > 0 then cast(((200 * {n} + {total}) // (2 * {total})) as double) / 100 end"


def buckets_sql(sessions: str, spec, with_share: bool = False) -> str:
    aggs = ["count(*) as total"]
    rows = []
    for metric, buckets in spec:
        for i, (name, lo, hi) in enumerate(buckets):
            alias = f"{metric}__{i}"
            aggs.append(f"count(*) filter (where {_bucket_cond(metric, lo, hi)}) as {alias}")
            extra = f", total, {_share(alias, 'total')} as ratio" if with_share else ""
            rows.append(f"select '{metric}' as metric, '{name}' as bucket, {i} as bucket_order, "
                        f"{alias} as n{extra} from agg")
    return f"with agg as (select {', '.join(aggs)} from ({sessions}) s)\n" + "\nunion all\n".join(rows)


def task_stats_sql(tasks: list[Task]) -> str:
    parts = []
    for t in tasks:
        aggs, outs = ["count(*) as session_count"], []
        for metric, buckets in FINE_SPEC:
            for name, lo, hi in buckets:
                aggs.append(f"count(*) filter (where {_bucket_cond(metric, lo, hi)}) as {metric}_{name}")
                outs.append(f"{_share(f'{metric}_{name}', 'session_count')} as {metric}_{name}_ratio")
        parts.append(f"""select cast({t.task_id} as bigint) as task_id, session_count, {', '.join(outs)}
from (select {', '.join(aggs)} from ({joined_sql(t, "week")}) j) c""")
    return "\nunion all\n".join(parts)


def _java_tokens(expr: str) -> str:
    """Tokens of ``expr`` split on spaces, trailing empty tokens dropped."""
    return (f"unnest(case when regexp_full_match({expr}, ' +') then []::varchar[] "
            f"else string_split(regexp_replace({expr}, ' +$', ''), ' ') end)")


DOC_LINES = "select unnest(string_split(text, chr(10))) as line from documents"
WORD_COUNT_SQL = (f"select word, count(*) as count from (select {_java_tokens('line')} as word "
                  f"from ({DOC_LINES}) l) t group by word")


def _hot_sql(source: str, keys: list[str], out: str, order: str) -> str:
    keycols = ", ".join(keys)
    part = ", ".join(["window_start"] + keys[:-1])
    return f"""with src as ({source}),
w as (select date_trunc('hour', ts) - i * interval 1 hour as window_start, {keycols}
      from src, unnest(range(0, 6)) r(i)),
c as (select window_start, window_start + interval 6 hour as window_end, {keycols}, count(*) as {out}
      from w group by all),
k as (select *, row_number() over (partition by {part} order by {out} desc, {order}) as rk from c)
select strftime(window_start, {TS}) as window_start, strftime(window_end, {TS}) as window_end,
  {keycols}, {out}, cast(rk as bigint) as rank from k where rk <= 3"""


SEARCH_SRC = f"select ts, 'kw' || cast({K} % 10 as varchar) as keyword from events where event_type = 'view'"
GOODS_SRC = "select ts, event_type as category, json_extract_string(props, '$.k') as product from events"


# Lines, then fields: what is left of a line without its trailing spaces, by position.
LINES_SRC = f"""select ts, f[3] as category, f[2] as product from (
  select ts, string_split(rtrim(case when event_id % 11 = 0 then cast(user_id as varchar)
    when event_id % 7 = 0 then cast(user_id as varchar) || ' ' || json_extract_string(props, '$.k') || ' '
    when event_id % 5 = 0 then cast(user_id as varchar) || ' ' || json_extract_string(props, '$.k') || ' ' || event_type || '  '
    else cast(user_id as varchar) || ' ' || json_extract_string(props, '$.k') || ' ' || event_type end, ' '), ' ') as f
  from events) l where len(f) >= 3"""


def _kv_sql() -> str:
    kw = "array_to_string(kw_list, ',')"
    cats = "array_to_string(cat_list, ',')"
    step = "case when length(cast(step_length as varchar)) = 2 then cast(step_length as varchar) else '0' || cast(step_length as varchar) end"
    record = (f"'session_id=' || session_id || '|search_keywords=' || {kw} || '|click_category_ids=' || {cats}"
              f" || '|step_length=' || {step} || '|visit_length=' || cast(visit_length as varchar)"
              f" || '|age=' || cast(age as varchar) || '|professional=' || professional || '|city=' || city"
              f" || '|sex=' || sex")
    return f"""select session_id, user_id, {record} as record,
  nullif({kw}, '') as search_keywords, nullif({kw}, '') is null as no_keywords,
  nullif({cats}, '') is not null as has_categories, nullif({cats}, '') as click_category_ids, {step} as step_length, visit_length, city,
  cast(null as varchar) as missing
from ({joined_sql(None, 'day')}) j"""


TIME_SQL = """with e as (select event_id, ts, strftime(ts, '%Y-%m-%d %-H:%M:%S') as t from events),
p as (select event_id, ts, t, try_strptime(t, '%Y-%m-%d %H:%M:%S') as parsed, split_part(t, ' ', 1) as d from e)
select event_id, t as action_time, cast(epoch(parsed) as bigint) as epoch_seconds,
  strftime(parsed, '%Y-%m-%d %H:%M:%S') as time_text, strftime(parsed, '%Y-%m-%d') as date_text,
  d || '_' || split_part(split_part(t, ' ', 2), ':', 1) as date_hour,
  strftime(cast(parsed as date) - interval 1 day, '%Y-%m-%d') as day_before, strftime(ts, '%Y-%m-%d') as same_day,
  coalesce(parsed < try_strptime(d || ' 12:00:00', '%Y-%m-%d %H:%M:%S'), false) as before_noon,
  coalesce(parsed > try_strptime(d || ' 12:00:00', '%Y-%m-%d %H:%M:%S'), false) as after_noon,
  coalesce(cast(epoch(parsed) - epoch(try_strptime(d || ' 0:00:00', '%Y-%m-%d %H:%M:%S')) as bigint), 0) as seconds_of_day
from p"""


def oracle_sql() -> dict[str, str]:
    lo, hi = SESSION_RANGE
    day_range_acts = f"select * from ({actions_sql('day')}) x {_date_where(lo, hi)}"
    fine = joined_sql(TASKS[0], 'week')
    return {
        "word_count": WORD_COUNT_SQL,
        "text_file_word_count": WORD_COUNT_SQL,
        "top_words": f"select word, count from ({WORD_COUNT_SQL}) w order by count desc, word limit {3}",
        "line_count_containing": (f"select line, count(*) as count from ({DOC_LINES}) l "
                                  f"where contains(line, 'g') group by line"),
        "parse_delimited": """with l as (select concat_ws(',', c_custkey, c_name, c_nationkey, c_mktsegment) as v from customer)
select cast(split_part(v, ',', 1) as bigint) as id, split_part(v, ',', 2) as name,
  cast(split_part(v, ',', 3) as integer) as nation from l""",
        "map_double": "select l_orderkey, l_linenumber, l_quantity * 2 as quantity_x2 from lineitem",
        "filter_even": (f"select l_orderkey, l_linenumber, l_quantity from lineitem "
                        f"where l_linenumber % 2 = 0"),
        "filter_order": (f"select c_custkey as id, c_name as name, c_nationkey as age from customer "
                         f"where c_nationkey <= 16 order by id"),
        "inner_join_sql": """select c.c_custkey as id, c.c_name as name, o.o_orderkey as order_key,
  o.o_totalprice as score from orders o inner join customer c on o.o_custkey = c.c_custkey""",
        "secondary_sort": (f"select o_orderkey, o_custkey, strftime(o_orderdate, {TS}) as o_orderdate, o_totalprice "
                           f"from orders order by o_orderdate desc, o_totalprice desc, o_orderkey"),
        "group_top_n": """select o_custkey, o_orderkey, o_totalprice, cast(rk as bigint) as rank from (
  select o_custkey, o_orderkey, o_totalprice,
    row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rk from orders) t
where rk <= 3""",
        "group_collect": "select user_id, event_id, count(*) as n from events group by user_id, event_id",
        "count_by_key": "select event_type, count(*) as count from events group by event_type",
        "count_by_column": ("select coalesce(search_keyword, 'null') as key, count(*) as count "
                            f"from ({actions_sql('day')}) a group by 1"),
        "date_range_scan": (f"select date, user_id, session_id, page_id, strftime(action_time, {TS}) as action_time, "
                            f"search_keyword, cast(click_category_id as varchar) as click_category_id, "
                            f"cast(click_product_id as varchar) as click_product_id, order_category_ids, "
                            f"order_product_ids, pay_category_ids, pay_product_ids from ({day_range_acts}) a"),
        "session_agg": f"select {SESSION_TEXT_COLS} from ({sessions_sql(actions_sql('day'))}) s",
        "session_user_join": f"select {JOINED_TEXT_COLS} from ({joined_sql(None, 'day')}) j",
        "session_filter": f"select {JOINED_TEXT_COLS} from ({fine}) j",
        "session_totals": f"""select cast(sum(step_length) as bigint) as total_actions, count(*) as total_sessions,
  count(u.user_id) as sessions_with_user
from ({sessions_sql(actions_sql('day'))}) s left join ({USERS_SQL}) u on s.user_id = u.user_id""",
        "session_buckets_coarse": buckets_sql(sessions_sql(actions_sql("month")), COARSE_SPEC),
        "session_buckets_fine": buckets_sql(fine, FINE_SPEC),
        "session_bucket_ratio": buckets_sql(fine, FINE_SPEC, with_share=True),
        "session_task_stats": task_stats_sql(TASKS),
        "session_kv": _kv_sql(),
        "time_normalise": TIME_SQL,
        "hot_search": _hot_sql(SEARCH_SRC, ["keyword"], "search_count", "keyword"),
        "hot_goods": _hot_sql(GOODS_SRC, ["category", "product"], "click_count", "product"),
        "hot_goods_lines": _hot_sql(LINES_SRC, ["category", "product"], "click_count", "product"),
        "stream_hot_search": _hot_sql(SEARCH_SRC, ["keyword"], "search_count", "keyword"),
        "stream_hot_goods": _hot_sql(GOODS_SRC, ["category", "product"], "click_count", "product"),
        "stream_hot_search_panes": _hot_sql(SEARCH_SRC, ["keyword"], "search_count", "keyword"),
        "stream_hot_search_versions": _hot_sql(SEARCH_SRC, ["keyword"], "search_count", "keyword"),
        "stream_hot_goods_versions": _hot_sql(GOODS_SRC, ["category", "product"], "click_count", "product"),
        "stream_user_gaps": """select user_id, count(*) as n_events, min(us) as first_us, max(us) as last_us,
  coalesce(max(us - before), 0) as longest_gap_us
from (select user_id, epoch_us(ts) as us, lag(epoch_us(ts)) over (partition by user_id order by ts) as before from events) e group by user_id""",
        "group_gather": f"""select user_id, (r - 1) // {GATHER_SIZE} as chunk, count(*) as n, string_agg(cast(event_id as varchar), ',' order by r) as event_ids
from (select user_id, event_id, row_number() over (partition by user_id order by event_id) as r from events) e group by 1, 2""",
        "session_task_index": task_stats_sql(TASKS),
        "session_task_days": task_stats_sql(TASKS),
        "session_values": (f"select distinct session_id, 'keyword' as kind, search_keyword as value from ({actions_sql('day')}) a where search_keyword <> '' "
                           f"union all select distinct session_id, 'category' as kind, cast(click_category_id as varchar) as value "
                           f"from ({actions_sql('day')}) b where click_category_id is not null"),
        "session_value_counts": f"select session_id, len(kw_list) as n_keywords, len(cat_list) as n_categories from ({sessions_sql(actions_sql('day'))}) s",
        "session_filter_facts": f"select session_id, step_length, visit_length, age, professional, city, sex, user_id from ({fine}) j",
        "stream_text_folder_count": WORD_COUNT_SQL,
        "stream_running_count": WORD_COUNT_SQL,
        "stream_batch_word_count": f"select word, count, cast(0 as bigint) as batch_id from ({WORD_COUNT_SQL}) w",
        "stream_topic_word_count": (f"select word, count(*) as count, cast(0 as bigint) as batch_id from "
                                    f"(select {_java_tokens('text')} as word from conversations) t group by word"),
    }
