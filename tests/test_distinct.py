import random

import pytest
from pyspark.sql import functions as F

from fareflow.operators.distinct import dense_codes, distinct_counts
from fareflow.sources.tables import RunFolder


@pytest.fixture(scope="module")
def bookings(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(300)]), rng.choice(["x", "y", None])) for _ in range(4000)]
    rows += [("empty", None, None), ("one", 7, None)]
    return rows, spark.createDataFrame(rows, "k string, v int, w string").repartition(6)


def test_codes_are_dense_and_in_order(bookings, rows):
    data, df = bookings
    found = sorted(rows(dense_codes(df, "v"), "code", "v", "n_rows"))
    values = sorted({v for _, v, _ in data if v is not None})
    assert found == [(i, v, sum(r[1] == v for r in data)) for i, v in enumerate(values, 1)]


def test_counts_by_group(spark, bookings, rows):
    data, df = bookings
    run = RunFolder(spark)
    codes = {c: dense_codes(df, c, run) for c in ("v", "w", "k")}
    found = rows(distinct_counts(df, ["k"], {"n_v": "v", "n_w": "w", "again": "v", "n_k": "k"}, codes))
    expected = []
    for k in {r[0] for r in data}:
        mine = [r for r in data if r[0] == k]
        n_v, n_w = (len({r[i] for r in mine if r[i] is not None}) for i in (1, 2))
        if n_v or n_w or k is not None:
            expected.append((k, n_v, n_w, n_v, int(k is not None)))
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_more_values_than_one_bitmap_holds(spark):
    df = spark.range(100_000).selectExpr("id % 2 AS k", "id DIV 2 AS v")
    found = distinct_counts(df, ["k"], {"n": "v"}, {"v": dense_codes(df, "v")})
    assert {r.k: r.n for r in found.collect()} == {0: 50_000, 1: 50_000}


def test_no_row_is_copied_for_a_count(spark, bookings):
    _, df = bookings
    codes = {c: dense_codes(df, c) for c in ("v", "w")}
    text = distinct_counts(df, ["k"], {"n_v": "v", "n_w": "w"}, codes)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "partial_bitmap_construct_agg" in text


def test_empty_table(spark, bookings):
    _, df = bookings
    none = df.limit(0)
    assert distinct_counts(none, ["k"], {"n": "v"}, {"v": dense_codes(none, "v")}).count() == 0
    assert dense_codes(df.where(F.col("v").isNull()), "v").count() == 0
