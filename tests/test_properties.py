"""Property tests: column helpers against small pure-Python models of the
Java semantics they reproduce. Each example is a whole batch of values,
evaluated in one Spark job."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlens import functions as fn


def java_split(s: str, sep: str) -> list[str]:
    """``String.split`` with a one-character literal separator."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def kv_get(record: str, key: str):
    for field in record.split("|"):
        if field.startswith(key + "="):
            return field[len(key) + 1:].split("=")[0] or None
    return None


def kv_set(record: str, key: str, value: str) -> str:
    fields = java_split(record, "|")
    for i, field in enumerate(fields):
        if field.split("=")[0] == key:
            fields[i] = f"{key}={value}"
            break
    return "|".join(fields)


def share(n: int, total: int):
    if total == 0:
        return None
    return float((Decimal(n) / Decimal(total)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


TEXT = st.text(alphabet="ab \t\n", max_size=8)
RECORD = st.text(alphabet="ab=|\n", max_size=12)
SETTINGS = settings(max_examples=8, deadline=None)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_java_split_space(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(fn.java_split(F.col("v"))).collect()]
    assert got == [java_split(v, " ") for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="ab,\n", max_size=6), min_size=1, max_size=60))
def test_java_split_other_separator_and_trim_pad(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(fn.java_split(F.col("v"), ","), fn.trim_comma(F.col("v")), fn.pad_two(F.col("v"))).collect()
    for v, (parts, trimmed, padded) in zip(values, got):
        assert parts == java_split(v, ",")
        t = v[1:] if v.startswith(",") else v
        t = t[:-1] if t.endswith(",") else t
        assert trimmed == t
        assert padded == (v if len(v) == 2 else "0" + v)


@SETTINGS
@given(st.lists(RECORD, min_size=1, max_size=60), st.sampled_from(["a", "b", "ab"]))
def test_kv_get_and_set(spark, records, key):
    df = spark.createDataFrame([(r,) for r in records], "r string")
    got = df.select(fn.kv_get(F.col("r"), key), fn.kv_set(F.col("r"), key, "v$1")).collect()
    for rec, (value, updated) in zip(records, got):
        assert value == kv_get(rec, key)
        assert updated == kv_set(rec, key, "v$1")


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=60))
def test_half_up_share(spark, pairs):
    pairs = [(min(n, t), t) for n, t in pairs]
    df = spark.createDataFrame(pairs, "n long, t long")
    got = [r[0] for r in df.select(fn.half_up_share(F.col("n"), F.col("t"))).collect()]
    assert got == [share(n, t) for n, t in pairs]


ACTION = st.tuples(
    st.sampled_from(["s1", "s2", "s3"]),
    st.integers(0, 3 * 86400 * 10**6),                        # microseconds after T0
    st.one_of(st.none(), st.sampled_from(["", "a", "b", "ab", "aab"])),
    st.one_of(st.none(), st.integers(0, 20)),
)


def session_model(actions):
    out = {}
    for sid, micros, kw, cat in actions:
        s = out.setdefault(sid, {"kw": set(), "cat": set(), "n": 0, "t": []})
        if kw:
            s["kw"].add(kw)
        if cat is not None:
            s["cat"].add(cat)
        s["n"] += 1
        s["t"].append(micros // 10**6)                          # whole seconds, as text times would be
    return {sid: (sorted(s["kw"]), sorted(s["cat"]), s["n"], max(s["t"]) - min(s["t"])) for sid, s in out.items()}


@SETTINGS
@given(st.lists(ACTION, min_size=1, max_size=80))
def test_session_agg_matches_model(spark, actions):
    import datetime as dt

    from visitlens.operators.sessions import merge_day_partials, session_agg, session_day_partials

    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(sid, 1, t0 + dt.timedelta(microseconds=m), kw, cat) for sid, m, kw, cat in actions],
        "session_id string, user_id long, action_time timestamp_ntz, search_keyword string, click_category_id long")
    def as_dict(sessions):
        return {r["session_id"]: (r["search_keywords"], r["click_category_ids"], r["step_length"],
                                  r["visit_length"]) for r in sessions.collect()}

    want = session_model(actions)
    assert as_dict(session_agg(df)) == want
    # merging per-day partials (the task-statistics path) gives the same sessions
    daily = df.withColumn("date", F.date_format("action_time", "yyyy-MM-dd"))
    assert as_dict(merge_day_partials(session_day_partials(daily), ("session_id",))) == want
