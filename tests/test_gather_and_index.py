"""Values gathered in chunks, and tasks found by their terms."""

import random
from collections import defaultdict

from visitlens.operators import relational as rel
from visitlens.operators import sessions as ses
from visitlens.operators import task_index
from visitlens.operators.materialize import materialize
from visitlens.plans import queries as q

from conftest import SF_SMALL


def test_chunks_hold_all_values_with_duplicates(spark):
    rng = random.Random(2)
    data = [(rng.choice([0, 0, 0, 1, 2, None]), rng.choice([None, *range(40)])) for _ in range(3000)] + [(0, 7)] * 900
    chunks = rel.gather_values(spark.createDataFrame(data, "k long, v long").repartition(6), "k", "v", 50).collect()
    got, want = defaultdict(list), defaultdict(list)
    for r in sorted(chunks, key=lambda r: r.chunk):
        assert r.n == len(r["values"]) <= 50 and r.chunk == len(got[r.k]) / 50
        got[r.k] += r["values"]
    for k, v in data:
        want[k].append(v)
    order = lambda v: (v is not None, v or 0)
    assert got == {k: sorted(vs, key=order) for k, vs in want.items()}
    assert rel.gather_values(spark.createDataFrame([], "k long, v long"), "k", "v").collect() == []


def test_a_hot_key_spreads_over_many_tasks(spark):
    from pyspark.sql import functions as F
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.lit(1).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        seen = {}
        original = rel.materialize

        def spy(df, label):
            seen["table"] = original(df, label)
            return seen["table"]

        rel.materialize = spy
        chunks = rel.gather_values(hot, "k", "v", 100)
        per_range = seen["table"].where("k = -1" if "k" in seen["table"].columns else "key = -1").groupBy(F.shiftright("place", 33)).count().collect()
    finally:
        rel.materialize = original
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(per_range) >= 8 and max(r["count"] for r in per_range) < 1500
    assert chunks.where("k = -1").count() == 60


def many_tasks(n):
    rng = random.Random(8)
    tasks = []
    for i in range(n):
        p = {}
        if rng.random() < .7:
            day = rng.randrange(1, 20)
            p["startDate"], p["endDate"] = f"2024-01-{day:02d}", f"2024-01-{day + rng.randrange(-1, 9):02d}"
        if rng.random() < .5:
            lo = rng.randrange(10, 60)
            p["startAge"], p["endAge"] = lo, lo + rng.randrange(-2, 9)
        if rng.random() < .4:
            p["sex"] = rng.choice(["male", "female"])
        if rng.random() < .5:
            p["keywords"] = ",".join({f"kw{rng.randrange(12)}" for _ in range(3)})
        if rng.random() < .4:
            p["categoryIds"] = ",".join(str(rng.randrange(100)) for _ in range(4))
        if rng.random() < .3:
            p["cities"] = f"NATION_{rng.randrange(25)},nowhere"
        if rng.random() < .2:
            p["professionals"] = rng.choice(["BUILDING", "none"])
        tasks.append((i, "{" + ",".join(f"'{k}':['{v}']" for k, v in p.items()) + "}"))
    return tasks


def test_index_equals_testing_every_task(spark):
    tasks = spark.createDataFrame(many_tasks(60), "task_id long, params string")
    actions, people = q._actions(spark, SF_SMALL, "week"), q._users(spark, SF_SMALL)
    want = sorted(map(tuple, ses.session_task_stats(actions, *people, tasks).collect()))
    assert sorted(map(tuple, task_index.task_stats_by_index(actions, *people, tasks).collect())) == want
    assert sum(r[1] > 0 for r in want) > 10


def test_rows_joined_grow_with_the_matches(spark):
    """1,000 tasks: the index meets a small part of the pairs of tasks and sessions."""
    from pyspark.sql import functions as F
    tasks = [(i, f"{{'keywords':['kw{i % 10}'],'startAge':['{10 + i % 50}'],'endAge':['{10 + i % 50}'],'categoryIds':['{i % 100}']}}") for i in range(1000)]
    actions, (users, cities) = q._actions(spark, SF_SMALL, "week"), q._users(spark, SF_SMALL)
    parsed = ses.parse_tasks(spark.createDataFrame(tasks, "task_id long, params string"))
    known = materialize(parsed.drop("start_date", "end_date").withColumn("range", F.lit("all")), "tasks")
    days = actions.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).withColumn("range", F.lit("all"))
    sessions = materialize(task_index.ranged_sessions(actions, users, cities, days), "sessions")
    matched = task_index.matched_sessions(sessions, known, users)
    pairs = sessions.count() * 1000
    filters = task_index.task_filters(known, users)
    lead = filters.where("kind = 'age'").select("task_id", F.explode("wanted").alias("term"))
    by_age = sessions.join(lead, F.col("age").cast("string") == F.col("term")).count()
    assert pairs > 50_000 and by_age < pairs / 20  # the leading kind costs no more than the ages do
    assert matched.count() == sessions.crossJoin(known.withColumnRenamed("sex", "t_sex").drop("range")).where(ses._task_matches()).count()
