"""Independent brute force in plain Python (no SQL engine) on the smallest
tables: a third derivation of the core results, next to Spark and DuckDB."""

import collections
import datetime as dt
import json

import pyarrow.parquet as pq

from conftest import SF_SMALL, rows
from visitlens.plans.queries import QUERIES


def _table(name):
    return pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pylist()


def _java_split(s):
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_word_count_by_brute_force(spark):
    want = collections.Counter(w for d in _table("documents") for line in d["text"].split("\n")
                               for w in _java_split(line))
    got = dict(rows(QUERIES["word_count"](spark, SF_SMALL)))
    assert got == dict(want)


def test_sessions_and_coarse_buckets_by_brute_force(spark):
    sessions = {}
    for e in _table("events"):
        ts = e["ts"]
        k = json.loads(e["props"])["k"]
        s = sessions.setdefault((e["user_id"], ts.strftime("%Y-%m")), {"kw": set(), "cat": set(), "t": []})
        if e["event_type"] == "view":
            s["kw"].add(f"kw{k % 10}")
        if e["event_type"] == "click":
            s["cat"].add(k)
        s["t"].append(ts.replace(microsecond=0))
    visits = [int((max(s["t"]) - min(s["t"])).total_seconds()) for s in sessions.values()]
    steps = [len(s["t"]) for s in sessions.values()]

    def bucket(v, edges):
        for name, lo, hi in edges:
            if v >= lo and (hi is None or v <= hi):
                return name

    from visitlens.operators.sessions import COARSE_STEP_BUCKETS, COARSE_VISIT_BUCKETS

    want = collections.Counter(("visit_length", bucket(v, COARSE_VISIT_BUCKETS)) for v in visits)
    want.update(("step_length", bucket(n, COARSE_STEP_BUCKETS)) for n in steps)
    got = {(m, b): n for m, b, _, n in rows(QUERIES["session_buckets_coarse"](spark, SF_SMALL))}
    assert {k: v for k, v in got.items() if v} == dict(want)


def test_hot_goods_by_brute_force(spark):
    counts = collections.Counter()
    for e in _table("events"):
        hour = e["ts"].replace(minute=0, second=0, microsecond=0)
        for i in range(6):
            start = hour - dt.timedelta(hours=i)
            counts[(start, e["event_type"], str(json.loads(e["props"])["k"]))] += 1
    groups = collections.defaultdict(list)
    for (start, cat, prod), n in counts.items():
        groups[(start, cat)].append((-n, prod))
    want = set()
    for (start, cat), items in groups.items():
        for rank, (neg, prod) in enumerate(sorted(items)[:3], 1):
            want.add((start.strftime("%Y-%m-%d %H:%M:%S"), cat, prod, -neg, rank))
    got = {(r["window_start"], r["category"], r["product"], r["click_count"], r["rank"])
           for r in QUERIES["hot_goods"](spark, SF_SMALL).collect()}
    assert got == want


def test_group_top_n_by_brute_force(spark):
    by_customer = collections.defaultdict(list)
    for o in _table("orders"):
        by_customer[o["o_custkey"]].append((-o["o_totalprice"], o["o_orderkey"]))
    want = {(c, key, -neg, rank) for c, items in by_customer.items()
            for rank, (neg, key) in enumerate(sorted(items)[:3], 1)}
    got = set(rows(QUERIES["group_top_n"](spark, SF_SMALL), "o_custkey", "o_orderkey", "o_totalprice", "rank"))
    assert got == want
