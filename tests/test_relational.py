"""Text and relational operators, including result order (which the
driver's order-insensitive hash does not check)."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import SF_SMALL, explain_text, rows
from visitlens.operators import relational as rel
from visitlens.operators import text
from visitlens.sources import parse_delimited


def test_word_count_java_tokens_and_order(spark):
    lines = spark.createDataFrame([("b a  a",), ("   ",), ("",), (" c",)], "value string")
    got = rows(text.word_count(lines))
    # "" comes from the double space, the empty line and the leading space: 3;
    # the all-space line gives no token; ties are ordered by word
    assert got == [("", 3), ("a", 2), ("b", 1), ("c", 1)]


def test_line_count_containing_is_case_sensitive(spark):
    lines = spark.createDataFrame([("go",), ("go",), ("Go",), ("egg",), ("x",)], "value string")
    assert rows(text.line_count_containing(lines, "g")) == [("go", 2), ("egg", 1)]


def test_group_top_n_small_groups_and_ties(spark):
    data = [("g1", 1, 10)] + [("g2", i, 5) for i in range(2)] + [("g3", i, 7) for i in range(3)] \
        + [("g4", 0, 9), ("g4", 1, 9), ("g4", 2, 8), ("g4", 3, 9)]
    df = spark.createDataFrame(data, "g string, id int, score int")
    top = rel.group_top_n(df, ["g"], [F.col("score").desc(), F.col("id")], 3)
    got = sorted(rows(top, "g", "id", "rank"))
    assert [r for r in got if r[0] == "g4"] == [("g4", 0, 1), ("g4", 1, 2), ("g4", 3, 3)]
    assert {g: sum(1 for r in got if r[0] == g) for g in ["g1", "g2", "g3", "g4"]} == {"g1": 1, "g2": 2, "g3": 3, "g4": 3}


def test_group_top_n_plans_partial_limit_before_shuffle(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    top = rel.group_top_n(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)
    plan = explain_text(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_secondary_sort_order(spark):
    lines = spark.createDataFrame([("1 5",), ("2 4",), ("3 6",), ("1 3",), ("2 1",)], "value string")
    parsed = parse_delimited(lines, StructType([StructField("first", IntegerType()),
                                                StructField("second", IntegerType())]), " ")
    parsed = parsed.withColumn("line", F.concat_ws(" ", "first", "second"))
    got = [r["line"] for r in rel.secondary_sort(parsed, [("first", True), ("second", True)]).collect()]
    assert got == ["3 6", "2 4", "2 1", "1 5", "1 3"]


def test_parse_delimited_extra_and_missing_fields(spark):
    lines = spark.createDataFrame([("1,ann,15,extra",), ("2,bob",)], "value string")
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()),
                         StructField("age", IntegerType())])
    assert rows(parse_delimited(lines, schema)) == [(1, "ann", 15), (2, "bob", None)]


def test_filter_order_and_map_double(spark):
    df = spark.createDataFrame([(3, 18), (1, 16), (2, 12)], "id int, age int")
    assert rows(rel.filter_order(df, "age", 16, ["id"])) == [(1, 16), (2, 12)]
    nums = spark.createDataFrame([(v,) for v in [0, 9, 22, 5, 18, 31]], "v int")
    assert [r[0] for r in rows(rel.map_double(nums, "v"))] == [0, 18, 44, 10, 36, 62]
    assert [r[0] for r in rows(rel.filter_even(nums, "v"))] == [0, 22, 18]


def test_sql_comma_join_becomes_equi_join(spark):
    st = spark.createDataFrame([(1, "a", 15), (2, "b", 17)], "id int, name string, age int")
    sc = spark.createDataFrame([(1, 90), (1, 80), (3, 70)], "id int, score int")
    out = rel.sql(spark, "select st.name, sc.score from {students} st, {score} sc where st.id = sc.id",
                  {"students": st, "score": sc})
    assert sorted(rows(out)) == [("a", 80), ("a", 90)]
    assert "CartesianProduct" not in explain_text(out)


def test_group_collect_multiset_and_count_by_key(spark):
    df = spark.createDataFrame([("tea", 7), ("tea", 7), ("jam", 3), ("tea", 2), ("rye", 3)], "k string, v int")
    assert sorted(rows(rel.group_collect(df, "k", "v"))) == [
        ("jam", 3, 1), ("rye", 3, 1), ("tea", 2, 1), ("tea", 7, 2)]
    assert sorted(rows(rel.count_by_key(df, "k"))) == [("jam", 1), ("rye", 1), ("tea", 3)]


def test_count_by_position_shows_null(spark):
    df = spark.createDataFrame([(1, 2, 3, "x"), (1, 2, 3, None), (1, 2, 3, None)], "a int, b int, c int, d string")
    assert sorted(rows(rel.count_by_position(df, 3))) == [("null", 2), ("x", 1)]


def test_top_n_takes_ordered_without_global_sort(spark):
    df = spark.createDataFrame([(w, c) for w, c in [("a", 5), ("b", 9), ("c", 5), ("d", 1)]], "word string, count long")
    top = rel.top_n(df, [F.col("count").desc(), F.col("word")], 3)
    assert rows(top) == [("b", 9), ("a", 5), ("c", 5)]
    assert "TakeOrderedAndProject" in explain_text(top)


def test_parameterised_sql_binds_values(spark):
    df = spark.createDataFrame([(3, "x", 18), (1, "y", 16), (2, "z", 12)], "id int, name string, age int")
    out = rel.sql(spark, "select * from {students} where age <= :max_age order by id", {"students": df},
                  args={"max_age": 16})
    assert rows(out) == [(1, "y", 16), (2, "z", 12)]


def test_sql_leaves_the_callers_views_alone(spark):
    from conftest import SF_SMALL
    from visitlens.plans.queries import QUERIES

    spark.createDataFrame([(42,)], "mine int").createOrReplaceTempView("customer")
    before = {t.name for t in spark.catalog.listTables()}
    try:
        assert QUERIES["inner_join_sql"](spark, SF_SMALL).count() > 0
        assert rows(spark.table("customer")) == [(42,)]
        assert {t.name for t in spark.catalog.listTables()} == before
    finally:
        spark.catalog.dropTempView("customer")
