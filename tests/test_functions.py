"""Column helpers against the edge fixtures (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from conftest import rows
from visitlens import functions as fn
from visitlens.functions.params import TaskParams


def test_java_split_keeps_leading_drops_trailing(spark):
    df = spark.createDataFrame([(0, "a b  "), (1, ""), (2, "   "), (3, " a")], "i int, v string")
    got = dict(rows(df.select("i", fn.java_split(F.col("v")).alias("t"))))
    assert got == {0: ["a", "b"], 1: [""], 2: [], 3: ["", "a"]}


def test_pad_two(spark):
    df = spark.createDataFrame([("5",), ("12",), ("123",), ("",)], "v string")
    assert [r[0] for r in rows(df.select(fn.pad_two(F.col("v"))))] == ["05", "12", "0123", "0"]


def test_trim_comma_strips_at_most_one_per_side(spark):
    df = spark.createDataFrame([(",,a,,",), ("a,",), (",",), (",,",)], "v string")
    assert [r[0] for r in rows(df.select(fn.trim_comma(F.col("v"))))] == [",a,", "a", "", ""]


def test_is_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "v string")
    assert rows(df.select(fn.is_empty(F.col("v")), fn.is_not_empty(F.col("v")))) == [
        (True, False), (True, False), (False, True)]


def test_kv_get_first_match_and_empty(spark):
    df = spark.createDataFrame([("a=1|b=|c=x=y|a=2",)], "r string")
    r = F.col("r")
    got = rows(df.select(*[fn.kv_get(r, k) for k in ["a", "b", "c", "z"]]))
    assert got == [("1", None, "x", None)]


def test_kv_set_replaces_first_or_keeps(spark):
    df = spark.createDataFrame([("a=1|b=2|c=3",), ("a=1|b=2|b=3",)], "r string")
    r = F.col("r")
    got = rows(df.select(fn.kv_set(r, "b", "9"), fn.kv_set(r, "z", "9")))
    assert got == [("a=1|b=9|c=3", "a=1|b=2|c=3"), ("a=1|b=9|b=3", "a=1|b=2|b=3")]


def test_kv_record_round_trip(spark):
    df = spark.createDataFrame([("s1", 7, None)], "s string, n int, m string")
    rec = fn.kv_record([("session_id", F.col("s")), ("steps", F.col("n")), ("city", F.col("m"))])
    out = df.select(rec.alias("r")).select("r", fn.kv_get(F.col("r"), "steps"), fn.kv_get(F.col("r"), "city"))
    assert rows(out) == [("session_id=s1|steps=7|city=", "7", None)]


def test_time_helpers(spark):
    df = spark.createDataFrame([("2019-04-08 5:07:08", "2019-04-08 15:07:08"), ("zz", "2019-04-08 5:07:08")],
                               "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = rows(df.select(fn.parse_time(a).isNotNull(), fn.date_hour(a), fn.before(a, b), fn.after(a, b),
                         fn.minus_seconds(b, a)))
    assert got[0] == (True, "2019-04-08_5", True, False, 36000)
    assert got[1][0] is False and got[1][2:] == (False, False, 0)


def test_format_and_yesterday(spark):
    df = spark.createDataFrame([("2024-03-01 5:07:08",)], "t string")
    p = fn.parse_time(F.col("t"))
    assert rows(df.select(fn.format_time(p), fn.format_date(p), fn.yesterday(p.cast("date")))) == [
        ("2024-03-01 05:07:08", "2024-03-01", "2024-02-29")]


def test_half_up_share(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 0), (2, 3), (1, 200)], "n long, t long")
    got = [r[0] for r in rows(df.select(fn.half_up_share(F.col("n"), F.col("t"))))]
    assert got == [0.13, 0.33, None, 0.67, 0.01]


def test_params_single_quoted_json():
    p = TaskParams.from_json("{'startAge':['21'],'endAge':['34'],'cities':['x,y'],'sex':[]}", task_id=3)
    assert (p.task_id, p.start_age, p.end_age, p.cities, p.sex, p.keywords) == (3, 21, 34, ("x", "y"), None, None)


def test_params_spark_side(spark):
    df = spark.createDataFrame([("{'startDate':['2024-01-01'],'cities':['a,b']}",)], "p string")
    m = fn.parse_params(F.col("p"))
    assert rows(df.select(fn.param_first(m, "startDate"), fn.param_first(m, "cities"),
                          fn.param_first(m, "sex"))) == [("2024-01-01", "a,b", None)]


def test_unparsed_times_are_counted_on_the_side(spark):
    from visitlens.operators.metrics import observe_counts

    df = spark.createDataFrame([("2019-04-08 5:07:08",), ("zz",), (None,)], "t string")
    parsed = fn.parse_time(F.col("t"))
    observed, obs = observe_counts(df.select(parsed.alias("p")), "t1", unparsed=F.col("p").isNull())
    assert observed.count() == 3
    assert obs.get == {"unparsed": 2}


def test_time_text_is_read_strictly(spark):
    # a one-digit month, hour 25 or a 13th month is no time here (it would be rolled over by a lenient reader)
    texts = ["2024-1-05 10:00:00", "2024-01-05 25:00:00", "2024-13-05 10:00:00", "2024-01-05 9:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] is None for r in rows(df.select(fn.parse_time(F.col("t"))))] == [True, True, True, False]
