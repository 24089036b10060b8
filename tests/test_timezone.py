"""Results do not depend on the caller's session time zone."""

import pytest

from conftest import SF_SMALL, rows
from visitlens.plans.queries import QUERIES

KEYS = ["session_agg", "session_bucket_ratio", "time_normalise", "hot_search", "stream_hot_search",
        "date_range_scan", "secondary_sort"]


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_same_results_in_other_session_zones(spark, zone):
    want = {k: sorted(rows(QUERIES[k](spark, SF_SMALL)), key=repr) for k in KEYS}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {k: sorted(rows(QUERIES[k](spark, SF_SMALL)), key=repr) for k in KEYS}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k in KEYS:
        assert got[k] == want[k], k


def test_wall_clock_round_trip_is_exact_across_dst(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from visitlens.functions import instant_as_wall_clock, wall_clock_as_instant

    walls = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 1, 1, 0, 0, 0, 7)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(w,) for w in walls], "w timestamp_ntz")
        inst = wall_clock_as_instant(F.col("w"))
        got = df.select(F.unix_micros(inst).alias("us"), instant_as_wall_clock(inst).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = dt.datetime(1970, 1, 1)
    assert [r["us"] for r in got] == [(w - epoch) // dt.timedelta(microseconds=1) for w in walls]
    assert [r["back"] for r in got] == walls


def test_visit_length_across_dst_is_wall_clock(spark):
    import datetime as dt

    from visitlens.operators.sessions import session_agg

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        acts = spark.createDataFrame(
            [("s", 1, dt.datetime(2024, 3, 10, 1, 59, 59), None, None),
             ("s", 1, dt.datetime(2024, 3, 10, 3, 0, 1), None, None)],
            "session_id string, user_id long, action_time timestamp_ntz, search_keyword string, "
            "click_category_id long")
        got = session_agg(acts).first()["visit_length"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 3602  # wall clock 01:59:59 -> 03:00:01, whatever the zone's DST rules
