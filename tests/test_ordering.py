import datetime as dt
import random

import pytest

from fareflow.operators.ordering import with_adjacent


def _brute(rows, step):
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    result = []
    for k, values in groups.items():
        distinct = sorted(set(values), reverse=step > 0)
        for i, v in enumerate(distinct):
            result.append((k, v, values.count(v), distinct[i - 1] if i else None))
    return set(result)


@pytest.mark.parametrize("step", [-1, 1])
def test_adjacent_by_key(spark, step):
    rng = random.Random(5)
    rows = [("hot", rng.randint(-10**6, 10**6)) for _ in range(600)]
    rows += [("hot", 10**15), ("hot", 4), ("hot", 4), ("hot", None)]
    rows += [(None, rng.randint(0, 30)) for _ in range(100)] + [("one", 9)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    got = with_adjacent(df, "v", ["k"], step=step).select("k", "v", "n_rows", "adjacent").collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == _brute(rows, step)


@pytest.mark.parametrize("step", [-1, 1])
def test_adjacent_without_key(spark, step):
    start = dt.datetime(2018, 3, 11)
    moments = [start + dt.timedelta(minutes=17 * i) for i in range(500)] + [dt.datetime(9999, 12, 31)]
    moments += moments[:20]
    df = spark.createDataFrame([(m,) for m in moments], "v timestamp_ntz").repartition(6)
    got = with_adjacent(df, "v", step=step).select("v", "n_rows", "adjacent").collect()
    assert {(None, *r) for r in map(tuple, got)} == _brute([(None, m) for m in moments], step)


def test_dates_and_doubles(spark):
    days = [dt.date(2020, 1, d) for d in (5, 3, 9)]
    df = spark.createDataFrame([(d, float(d.day)) for d in days], "d date, x double")
    assert {tuple(r) for r in with_adjacent(df, "d").select("d", "adjacent").collect()} == {
        (days[1], None), (days[0], days[1]), (days[2], days[0])}
    assert {tuple(r) for r in with_adjacent(df, "x").select("x", "adjacent").collect()} == {
        (3.0, None), (5.0, 3.0), (9.0, 5.0)}


def test_keys_and_ranges_of_any_size(spark):
    """A hot key over several ranges, keys that begin and end inside one, NULL keys, and rows in several columns."""
    from fareflow.operators.ordering import with_neighbour

    rng = random.Random(8)
    rows = sorted({("hot", rng.randrange(10**9), rng.randrange(3)) for _ in range(3000)}
                  | {(f"k{i % 200}", i, 0) for i in range(700)} | {(None, i, 1) for i in range(30)}, key=lambda r: (r[0] is not None, r))
    df = spark.createDataFrame(rows, "k string, a long, b int").repartition(7)
    for step in (-1, 1):
        found = {tuple(r)[:3]: r["near"] and tuple(r["near"]) for r in with_neighbour(df, ["k"], ["a", "b"], step, "near").collect()}
        line = rows if step > 0 else rows[::-1]
        expected = {r: (n[1:] if n and n[0] == r[0] else None) for r, n in zip(line, [*line[1:], None])}
        assert found == expected


def test_a_shuffled_row_moves_few_times(spark):
    """Rows are counted on the map side, then put in ranges, then ranked inside ranges: three exchanges, one scan."""
    df = spark.range(1000).selectExpr("id % 100 AS v")
    text = with_adjacent(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 2 and "SortMergeJoin" not in text
    assert text.count("Exchange SinglePartition") == 1  # the edges, one row a range
