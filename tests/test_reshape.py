import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareflow.operators import aggregates, relations, reshape


def test_pivot(spark, rows):
    df = spark.createDataFrame(
        [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    got = df.groupBy("size").agg(*reshape.pivot(F.col("color"), ["red", "blue", "blue's"], quote=False))
    assert got.columns == ["size", "red", "blue", "blues"]
    assert rows(got) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    other = df.groupBy("size").agg(*reshape.pivot(
        F.col("color"), ["red"], agg=F.count_distinct, cmp="<>", prefix="not_", suffix="_n",
        then=F.col("color"), otherwise=None))
    assert other.columns == ["size", "not_red_n"] and rows(other) == [("M", 0), ("S", 2)]
    assert reshape.plain_name("1 Odd-Name's") == "_1_odd_names"


def test_column_values(spark):
    letters = list("abcdef") + ["g"] * 5 + [None, None]
    sides = ["left", "right"]
    df = spark.createDataFrame(
        [(x, sides[i % 2]) for i, x in enumerate(letters)], "field string, side string")
    assert reshape.column_values(df, "field", limit=2) == ["g", None]
    assert sorted(reshape.column_values(df.dropna(), "field")) == list("abcdefg")
    assert sorted(v or "" for v in reshape.column_values(df, "field", where="side = 'left'")) == [
        "", "a", "c", "e", "g"]
    assert reshape.column_values(df, "field", limit=1, order_by=[F.asc_nulls_last("value")]) == ["a"]
    assert len(reshape.column_values(df, "field", max_values=8)) == 8
    with pytest.raises(ValueError):
        reshape.column_values(df, "field", max_values=7)


def test_unpivot(spark, rows):
    df = spark.createDataFrame(
        [(123, "2017-01-01", "active", "tier 1", True), (567, "2017-03-01", "churned", "tier 2", None)],
        "customer_id int, created_at string, status string, segment string, is_updated boolean")
    got = reshape.unpivot(df, keep=["customer_id"], remove=["CREATED_AT"],
                          field_name="prop", value_name="val")
    assert got.columns == ["customer_id", "prop", "val"]
    assert set(rows(got)) == {
        (123, "status", "active"), (123, "segment", "tier 1"), (123, "is_updated", "true"),
        (567, "status", "churned"), (567, "segment", "tier 2"), (567, "is_updated", None)}


def test_union_relations(spark, rows):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e")],
                                "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7)], "id long, favorite_color string, favorite_number int")
    got = reshape.union_relations({"one": one, "two": two})
    assert got.dtypes == [("source_relation", "string"), ("id", "int"), ("name", "string"),
                          ("favorite_number", "string"), ("favorite_color", "string")]
    assert set(rows(got)) == {("one", 1, "drew", "pi", None), ("one", 2, "bob", "e", None),
                              ("two", 1, None, "7", "green")}
    only = reshape.union_relations({"one": one, "two": two}, include=["id"], source_column=None,
                                   column_types={"id": "string"}, where="id = 1")
    assert rows(only) == [("1",), ("1",)]
    left = reshape.union_relations({"one": one, "two": two}, exclude=["name", "favorite_color"])
    assert left.columns == ["source_relation", "id", "favorite_number"]
    with pytest.raises(ValueError):
        reshape.union_relations({"one": one}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"one": one}, include=["nothing"])


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, None, 1), (None, "x", 1), (None, "x", 2)],
                               "user_id int, event string, version int")
    got = reshape.deduplicate(df, ["user_id"], [F.desc("version")])
    assert set(rows(got)) == {(1, "play", 2), (2, None, 1), (None, "x", 2)}
    with pytest.raises(ValueError):
        reshape.deduplicate(df, ["user_id"], [])


def test_generated_relations(spark, rows):
    assert rows(reshape.generate_series(spark, 10)) == [(i,) for i in range(1, 11)]
    with pytest.raises(ValueError):
        reshape.generate_series(spark, 0)
    days = reshape.date_spine(spark, "day", "2018-01-01", "2018-01-10")
    assert rows(days) == [(dt.date(2018, 1, d),) for d in range(1, 10)] and days.columns == ["date_day"]
    months = reshape.date_spine(spark, "month", "2018-01-31", "2018-04-01")
    assert rows(months) == [(dt.date(2018, 1, 31),), (dt.date(2018, 2, 28),), (dt.date(2018, 3, 31),)]
    hours = reshape.date_spine(spark, "hour", "2018-03-11 00:00:00", "2018-03-11 05:00:00")
    assert rows(hours) == [(dt.datetime(2018, 3, 11, h),) for h in range(5)]
    with pytest.raises(ValueError):
        reshape.date_spine(spark, "day", "2018-01-10", "2018-01-10")


def test_star_and_blanks(spark, rows):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2)], "field_1 string, field_2 string, field_3 int")
    assert reshape.columns_except(df, ["FIELD_2"]) == ["field_1", "field_3"]
    assert reshape.star(df, ["field_3"]).columns == ["field_1", "field_2"]
    assert reshape.star(df, prefix="p_", suffix="_s").columns == ["p_field_1_s", "p_field_2_s", "p_field_3_s"]
    assert set(rows(reshape.blanks_to_null(df))) == {("a", None, 1), (None, "b", 2)}


def test_set_operations(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "x int")
    assert rows(reshape.without_rows(a, b)) == [(1,)]
    assert rows(reshape.common_rows(a, b)) == [(None,), (2,)]


LIST_ROWS = [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 2), (2, "1", 1), (2, "p", 3),
             (3, "g", 1), (3, "g", 2), (3, "g", 3), (4, None, 1)]


def test_list_text(spark, rows):
    df = spark.createDataFrame(LIST_ROWS, "g int, t string, o int")
    text, order = F.col("t"), F.col("o")

    def listed(**options):
        return [r[1] for r in rows(df.groupBy("g").agg(aggregates.list_text(text, **options).alias("l")))]

    assert listed(delimiter="_|_", order_by=order) == ["a_|_b_|_c", "1_|_a_|_p", "g_|_g_|_g", ""]
    assert listed(delimiter=", ")[2] == "g, g, g"
    assert listed(distinct=True)[2] == "g"
    assert listed()[2] == "g,g,g"
    first = aggregates.first_list_text(df, ["g"], "t", ["o"], 2, "l", "_|_")
    assert rows(first) == [(1, "a_|_b"), (2, "1_|_a"), (3, "g_|_g")]


def test_group_aggregates(spark, rows):
    df = spark.createDataFrame(
        [("abc", 1, 1), ("abc", 1, 0), ("def", 1, 0), ("hij", 1, 1), ("hij", 1, None), ("klm", 1, 0),
         ("klm", 1, None)], "key string, val1 int, val2 int")
    got = aggregates.group_by_first(df, 1).agg(
        aggregates.bool_or(F.col("val1") == F.col("val2")).alias("value"),
        aggregates.any_value(F.upper("key")).alias("name"))
    assert rows(got) == [("abc", True, "ABC"), ("def", False, "DEF"), ("hij", True, "HIJ"),
                         ("klm", False, "KLM")]


def test_tables_by_name(spark, rows):
    for day in (1, 2, 3):
        spark.createDataFrame([(2 * day - 1, "play"), (2 * day, "pause")], "user_id int, event string") \
            .createOrReplaceTempView(f"data_events_2018010{day}")
    spark.range(1).createOrReplaceTempView("data_evenx")
    found = relations.tables_like(spark, "%", "DATA_events_2018%", "%03")
    assert list(found) == ["data_events_20180101", "data_events_20180102"]
    every = relations.tables_with_prefix(spark, "", "data_events_")
    assert rows(reshape.union_relations(every, source_column=None), "user_id") == [
        (i,) for i in range(1, 7)]
    assert relations.like_regex("a_c%").match("ABCDE") and not relations.like_regex("a.c").match("abc")
    for name in spark.catalog.listTables():
        if name.name.startswith("data_even"):
            spark.catalog.dropTempView(name.name)
