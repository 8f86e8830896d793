import random

import pytest
from pyspark.sql import functions as F

from fareflow.operators.joins import lookup
from fareflow.operators.sampling import first_per_group, stratified_sample


@pytest.mark.parametrize("match_nulls", [False, True])
@pytest.mark.parametrize("limits", [(2 ** 40, 10), (0, 10), (0, 10 ** 9), (0, 0)])
def test_lookup_gives_the_same_rows_however_it_runs(spark, rows, tmp_path, match_nulls, limits):
    rng = random.Random(4)
    keys = ["hot"] * 300 + [f"k{i % 40}" for i in range(300)] + [None] * 30 + ["absent"] * 3
    facts = spark.createDataFrame([(i, k, rng.choice([1, 2, None])) for i, k in enumerate(keys)],
                                  "id int, k string, g int")
    facts.where("k <> 'absent' OR k IS NULL").groupBy("k", "g").agg(
        F.count("*").alias("n"), F.max("id").alias("top")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = lookup(facts, table, ["k", "g"], ["top"], "n", match_nulls, *limits)
    known = {(r["k"], r["g"]): r["top"] for r in table.collect()
             if match_nulls or (r["k"] is not None and r["g"] is not None)}
    assert rows(got) == [(r["id"], r["k"], r["g"], known.get((r["k"], r["g"])))
                         for r in sorted(facts.collect(), key=lambda r: r["id"])]


def test_hot_absent_and_null_keys_are_spread(spark, tmp_path):
    """A third of the facts has a hot key, a third a hot key that the table lacks, and a sixth none at all."""
    facts = spark.range(60_000).repartition(6).selectExpr(
        "id", "CASE WHEN id % 6 < 2 THEN 'hot' WHEN id % 6 < 4 THEN 'absent' WHEN id % 6 = 4 THEN concat('k', id % 997) END AS k")
    sizes = facts.groupBy("k").agg(F.count("*").alias("n"))
    sizes.where("k <> 'absent'").withColumn("top", F.length("k")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        got = lookup(facts, table, ["k"], ["top"], "n", broadcast_bytes=0, hot_rows=300, sizes=sizes)
        tasks = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        assert len(tasks) == 4 and tasks[-1] < 2 * tasks[2]
        # Chained: what comes out of one look-up goes into the next; facts are read once.
        chained = lookup(got, table.withColumnRenamed("top", "again"), ["k"], ["again"], "n", broadcast_bytes=0, hot_rows=300, sizes=sizes)
        assert chained.where("top IS DISTINCT FROM again").count() == 0
        assert chained.count() == 60_000 and chained.where("top = 3").count() > 20_000 - 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.fixture(scope="module")
def bookings(spark):
    rng = random.Random(6)
    sizes = {"hot": 6000, "mid": 900, "small": 3, None: 40}
    data = [(f"{s}-{i}", s, rng.random()) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "legid string, s string, x double"), sizes


def _sample(df, **options):
    settings = dict(rate=0.018, at_least=5, at_most=100, seed="s")
    return stratified_sample(df, ["s"], "legid", **{**settings, **options})


def test_sample_sizes_and_weights(bookings):
    df, sizes = bookings
    got = _sample(df).groupBy("s").agg(F.count("*").alias("n"), F.sum("sample_weight").alias("w"))
    result = {r["s"]: (r["n"], r["w"]) for r in got.collect()}
    assert {s: n for s, (n, _) in result.items()} == {"hot": 100, "mid": 16, "small": 3, None: 5}
    for s, (_, w) in result.items():
        assert w == pytest.approx(sizes[s])


def test_sample_does_not_depend_on_partitioning(bookings, rows):
    df, _ = bookings
    once = rows(_sample(df.repartition(1)), "legid")
    assert once == rows(_sample(df.repartition(9, "x")), "legid")
    assert once != rows(_sample(df, seed="other"), "legid")


def test_large_samples_are_trimmed_by_salt(bookings, rows):
    df, _ = bookings
    order = [F.md5("legid"), F.col("legid")]
    got = rows(first_per_group(df, ["s"], order, 1500, "place"), "s", "legid", "place")
    by_group = {}
    for s, legid, place in got:
        by_group.setdefault(s, []).append((place, legid))
    assert {s: len(v) for s, v in by_group.items()} == {"hot": 1500, "mid": 900, "small": 3, None: 40}
    import hashlib
    ids = sorted((f"hot-{i}" for i in range(6000)), key=lambda v: hashlib.md5(v.encode()).hexdigest())
    assert [legid for _, legid in sorted(by_group["hot"])] == ids[:1500]


@pytest.mark.parametrize("spare", [None, (-1, 0)])
def test_few_rows_are_ranked_and_the_sample_stays_the_same(bookings, rows, monkeypatch, spare):
    """By hash limits, by the plain ranking of all rows, and where limits leave strata short of rows."""
    from fareflow.operators import sampling

    df, sizes = bookings
    plain = rows(_sample(df, broadcast_bytes=-1))
    if spare:
        monkeypatch.setattr(sampling, "SPARE_DEVIATIONS", spare[0])
        monkeypatch.setattr(sampling, "SPARE_ROWS", spare[1])
    ranked = []
    first = sampling.first_per_group
    monkeypatch.setattr(sampling, "first_per_group", lambda df, *a: ranked.append(df.count()) or first(df, *a))
    assert rows(_sample(df)) == plain
    assert spare or ranked[0] < sum(sizes.values()) / 10


def test_the_limit_of_a_sample_is_text_like_the_hashes(spark):
    from fareflow.operators.sampling import HASH_DIGITS, _last_digits

    shares = spark.createDataFrame([(0.0,), (0.5,), (2.0 ** -48,), (1 - 2.0 ** -48,), (1.0,), (7.5,)], "share double")
    found = [r[0] for r in shares.select(_last_digits(F.col("share"))).collect()]
    top = "f" * HASH_DIGITS
    assert found == ["0" * 12, "8" + "0" * 11, "0" * 11 + "1", top, top, top]
