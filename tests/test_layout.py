"""Bucketed layout: the session aggregate and the user join run shuffle-free."""

import uuid

from conftest import SF_SMALL, explain_text, rows
from visitlens.operators import sessions as ses
from visitlens.operators.layout import save_bucketed


def test_user_bucketed_tables_need_no_shuffle(spark):
    suffix = uuid.uuid4().hex[:8]
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    users = ses.users_from_customer(spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
    cities = ses.cities_from_nation(spark.read.parquet(f"{SF_SMALL}/nation.parquet"))
    ev_b = save_bucketed(events, f"events_by_user_{suffix}", "user_id", 4)
    us_b = save_bucketed(users.select("user_id", "age", "sex"), f"users_by_user_{suffix}", "user_id", 4)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sessions = ses.session_agg(ses.actions_from_events(ev_b), keys=("user_id", "session_id"))
        joined = sessions.join(us_b, "user_id", "inner")
        plan = explain_text(joined)
        assert "Exchange" not in plan, plan
        got = sorted(rows(joined.select("session_id", "step_length", "visit_length", "age")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # same sessions as the plain pipeline
    plain = ses.session_user_join(ses.session_agg(ses.actions_from_events(events)), users, cities)
    assert got == sorted(rows(plain.select("session_id", "step_length", "visit_length", "age")))
