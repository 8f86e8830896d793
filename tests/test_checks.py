"""Every check on data that must pass and on data that must fail."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareflow.operators import checks


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_not_null_and_unique(spark, rows):
    df = frame(spark, "id int, deleted boolean", (1, False), (2, False), (None, True), (2, True))
    assert rows(checks.not_null(df, "id", "NOT deleted")) == []
    assert rows(checks.not_null(df, "id")) == [(None, True)]
    assert rows(checks.unique(df, "id", "NOT deleted")) == []
    assert rows(checks.unique(df, "id")) == [(2, 2)]
    twice_null = frame(spark, "id int", (None,), (None,))
    assert rows(checks.unique(twice_null, "id")) == []
    assert rows(checks.unique_combination_of_columns(twice_null, ["id"])) == [(None, 2)]


def test_unique_combination(spark, rows):
    df = frame(spark, "m string, p string", ("01", "a"), ("01", "b"), ("02", "a"))
    assert rows(checks.unique_combination_of_columns(df, ["m", "p"])) == []
    assert rows(checks.unique_combination_of_columns(df, ["m"])) == [("01", 2)]


def test_value_lists(spark, rows):
    df = frame(spark, "city string", ("Barcelona",), ("London",), ("London",), (None,))
    assert rows(checks.accepted_values(df, "city", ["Barcelona", "London"])) == []
    assert rows(checks.accepted_values(df, "city", ["Barcelona"])) == [("London", 2)]
    assert rows(checks.not_accepted_values(df, "city", ["Madrid", "Berlin"])) == []
    assert rows(checks.not_accepted_values(df, "city", ["London"])) == [("London", 2)]


def test_accepted_range(spark, rows):
    df = frame(spark, "id double", (-1.0,), (11.0,), (None,))
    assert rows(checks.accepted_range(df, "id", -1, 11)) == []
    assert rows(checks.accepted_range(df, "id", -2, 11.1, inclusive=False)) == []
    assert rows(checks.accepted_range(df, "id", 0, where="id <> -1")) == []
    assert rows(checks.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1.0,), (11.0,)]
    assert rows(checks.accepted_range(df, "id", 0)) == [(-1.0,)]


def test_expression_is_true(spark, rows):
    df = frame(spark, "a double, b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert rows(checks.expression_is_true(df, "a + b = 1")) == []
    assert rows(checks.expression_is_true(df, "+ b = 1", column="a")) == []
    assert rows(checks.expression_is_true(df, "= 0.5", column="b", where="a = 0.5")) == []
    assert rows(checks.expression_is_true(df, "a > b")) == [(0.0, 1.0), (0.5, 0.5)]


def test_one_number_checks(spark, rows):
    df = frame(spark, "v string, w int", ("a", 1), (None, 1), ("b", 1), ("b", None))
    assert rows(checks.at_least_one(df, "v")) == []
    assert rows(checks.at_least_one(df.where("v IS NULL"), "v")) == [(0,)]
    assert rows(checks.not_constant(df, "v")) == []
    assert rows(checks.not_constant(df, "w")) == [(1,)]
    assert rows(checks.not_constant(df.where("w IS NULL"), "w")) == []
    assert rows(checks.not_null_proportion(df, "v", 0.75, 0.75)) == []
    assert rows(checks.not_null_proportion(df, "v", 0.8)) == [(0.75,)]
    assert rows(checks.not_null_proportion(df, "v", 0.1, 0.5)) == [(0.75,)]
    assert rows(checks.not_null_proportion(df.where("false"), "v", 0.9)) == []


def test_recency(spark, rows):
    df = frame(spark, "t timestamp_ntz", (dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 9),))
    now = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    assert rows(checks.recency(df, "t", "day", 1, now)) == []
    assert rows(checks.recency(df, "t", "hour", 12, now)) == [
        (dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 9, 12))]
    assert rows(checks.recency(df.where("false"), "t", "day", 1, now)) == []
    assert len(rows(checks.recency(df, "t", "day", 1))) == 1


def test_row_counts(spark, rows):
    three, four = spark.range(3), spark.range(4)
    assert rows(checks.equal_rowcount(three, three)) == [(3, 3, 0)]
    assert rows(checks.equal_rowcount(three, four)) == [(3, 4, 1)]
    assert rows(checks.fewer_rows_than(three, four)) == [(3, 4, 0)]
    assert rows(checks.fewer_rows_than(three, three)) == [(3, 3, 1)]
    assert rows(checks.fewer_rows_than(four.union(four), three)) == [(8, 3, 5)]
    assert rows(checks.equal_rowcount(three.where("false"), three.where("false"))) == [(0, 0, 0)]


def test_equality(spark, rows):
    a = frame(spark, "x int, y string", (1, "p"), (2, None), (2, None))
    b = frame(spark, "x int, y string", (1, "p"), (2, None))
    assert rows(checks.equality(a, b)) == []
    assert rows(checks.equality(a, b, strict=True)) == [("a_minus_b", 2, None)]
    c = frame(spark, "x int, y string", (1, "q"), (2, None), (3, "r"))
    assert rows(checks.equality(a, c, ["x"])) == [("b_minus_a", 3)]
    different = checks.equality(a, c)
    assert rows(different) == [("a_minus_b", 1, "p"), ("b_minus_a", 1, "q"), ("b_minus_a", 3, "r")]
    total = checks.summarise([checks.Outcome("e", "a", different, checks.equality_failures())])
    assert rows(total) == [("e", "a", 4)]


def test_cardinality_equality(spark, rows):
    a = frame(spark, "same int", (1,), (2,), (3,), (None,))
    b = frame(spark, "same int, other int", (1, 2), (2, 3), (3, 1), (None, None))
    assert rows(checks.cardinality_equality(a, "same", b, "same")) == []
    assert rows(checks.cardinality_equality(a, "same", b, "other")) == []
    c = frame(spark, "same int", (1,), (1,), (3,), (None,))
    assert rows(checks.cardinality_equality(a, "same", c, "same")) == [
        (1, "a_minus_b", 1), (1, "b_minus_a", 2), (2, "a_minus_b", 1)]


def test_relationships_where(spark, rows):
    parent = frame(spark, "id int", (1,), (2,), (3,))
    child = frame(spark, "id int", (1,), (2,), (4,), (4,), (None,))
    assert rows(checks.relationships_where(child, "id", parent, "id", "id <> 4")) == []
    assert rows(checks.relationships_where(child, "id", parent, "id")) == [(4, 2)]
    assert rows(checks.relationships_where(child, "id", parent, "id", "id <> 4", "id > 1")) == [(1, 1)]


def test_sequential_values(spark, rows):
    even = frame(spark, "v int", (2,), (4,), (6,), (8,), (10,))
    assert rows(checks.sequential_values(even, "v", 2)) == []
    assert rows(checks.sequential_values(even, "v", 1)) == [(4, 2, 1), (6, 4, 1), (8, 6, 1), (10, 8, 1)]
    broken = frame(spark, "v int", (1,), (2,), (2,), (2,), (5,))
    assert rows(checks.sequential_values(broken, "v")) == [(2, 2, 2), (5, 2, 1)]
    hours = frame(spark, "t timestamp_ntz", *[(dt.datetime(2021, 3, 14, h),) for h in range(5)])
    assert rows(checks.sequential_values(hours, "t", 1, "hour")) == []
    assert len(rows(checks.sequential_values(hours.where("hour(t) <> 2"), "t", 1, "hour"))) == 1


RANGES = "s int, lo date, hi date"
D = dt.date


def test_ranges_without_gaps(spark, rows):
    df = frame(spark, "lo int, hi int", (0, 1), (1, 2), (2, 4))
    for gaps in ("not_allowed", "allowed"):
        assert rows(checks.mutually_exclusive_ranges(df, "lo", "hi", gaps=gaps)) == []
    touching = checks.mutually_exclusive_ranges(df, "lo", "hi", gaps="required")
    assert rows(touching, "lower_bound", "next_lower_bound") == [(0, 1), (1, 2)]
    overlap = df.union(frame(spark, "lo int, hi int", (3, 5)))
    assert rows(checks.mutually_exclusive_ranges(overlap, "lo", "hi"),
                "lower_bound", "next_lower_bound", "is_last_record") == [(2, 3, False)]
    with pytest.raises(ValueError):
        checks.mutually_exclusive_ranges(df, "lo", "hi", gaps="some")


def test_ranges_with_gaps(spark, rows):
    df = frame(spark, RANGES, (1, D(2019, 1, 1), D(2019, 2, 1)), (1, D(2019, 3, 3), D(2019, 4, 1)),
               (2, D(2019, 5, 6), D(2019, 7, 2)), (2, D(2019, 7, 3), None))
    upper = "coalesce(hi, DATE '2099-01-01')"
    for gaps in ("allowed", "required"):
        assert rows(checks.mutually_exclusive_ranges(df, "lo", upper, "s", gaps)) == []
    assert len(rows(checks.mutually_exclusive_ranges(df, "lo", upper, "s", "not_allowed"))) == 2
    open_end = checks.mutually_exclusive_ranges(df, "lo", "hi", "s")
    assert rows(open_end, "lower_bound", "is_last_record") == [(D(2019, 7, 3), True)]


def test_zero_length_and_repeated_ranges(spark, rows):
    df = frame(spark, RANGES, (3, D(2020, 5, 6), D(2020, 5, 7)), (3, D(2020, 5, 8), D(2020, 5, 10)),
               (3, D(2020, 5, 8), D(2020, 5, 8)), (3, D(2020, 5, 12), D(2020, 5, 15)),
               (4, D(2020, 6, 8), D(2020, 6, 8)), (4, D(2020, 6, 9), D(2020, 6, 10)))
    check = checks.mutually_exclusive_ranges
    assert rows(check(df, "lo", "hi", "s", zero_length_range_allowed=True)) == []
    assert rows(check(df, "lo", "hi", "s"), "lower_bound") == [(D(2020, 5, 8),), (D(2020, 6, 8),)]
    thrice = frame(spark, "lo int, hi int", (1, 2), (1, 2), (1, 2), (2, 3))
    assert rows(check(thrice, "lo", "hi"), "lower_bound", "next_lower_bound", "n_rows") == [(1, 1, 2)]


def test_ranges_with_null_bounds(spark, rows):
    df = frame(spark, "lo int, hi int", (0, 1), (2, 3), (None, 9))
    found = checks.mutually_exclusive_ranges(df, "lo", "hi")
    # A NULL lower bound sorts last: it fails, and the range before it is no longer the last.
    assert set(rows(found, "lower_bound", "upper_bound")) == {(2, 3), (None, 9)}
    same_start = frame(spark, "lo int, hi int", (0, 5), (0, None))
    got = checks.mutually_exclusive_ranges(same_start, "lo", "hi")
    assert set(rows(got, "upper_bound", "next_lower_bound")) == {(5, 0), (None, None)}


def test_helpers(spark, rows):
    df = frame(spark, "a string, b string", ("x", "x"), (None, None), ("y", None), ("", "z"))
    assert set(rows(checks.columns_equal(df, "a", "b"))) == {("", "z"), ("y", None)}
    assert rows(checks.not_empty_string(df, "a")) == [("", "z")]
    assert checks.columns_match_set(df, ["A", "b"]) == (set(), set())
    assert checks.columns_match_set(df, ["a", "c"]) == ({"c"}, {"b"})


def test_summary_counts_rows(spark, rows):
    df = frame(spark, "id int", (1,), (None,))
    summary = checks.summarise([
        checks.Outcome("not_null_id", "t", checks.not_null(df, "id")),
        checks.Outcome("unique_id", "t", checks.unique(df, "id")),
        checks.Outcome("rows", "t", checks.equal_rowcount(df, df), F.sum("diff_count")),
    ])
    assert rows(summary) == [("not_null_id", "t", 1), ("rows", "t", 0), ("unique_id", "t", 0)]
