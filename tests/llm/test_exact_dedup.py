from pyspark.sql import functions as F

from fareflow.llm.exact_dedup import duplicate_groups, sha256, without_duplicates

SCHEMA = "doc_id long, text string, TEXT2 string, kept string, _digest int"
ROWS = [
    (1, "a", "x", "k", 1), (2, "a", "x", "k", 1), (3, "b", None, None, None), (None, "b", "q", "k", 2),
    (4, None, "x", "k", 1), (5, "", "x", "k", 1), (6, "A", "x", "k", 1), (6, "A", "w", "k", 1),
    (None, "n", "x", "k", 1), (None, "n", "x", "k", 1), (7, "long " * 50_000, "x", "k", 1),
]


def brute(rows):
    texts = {}
    for r in rows:
        texts.setdefault(r[1] or "", []).append(r[0])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in texts.items()}
    return sorted(((r[0], best[r[1] or ""], len(texts[r[1] or ""])) for r in rows), key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size) for r in df.collect()), key=str)


def weak(text):
    """Nearly all texts share a digest, so that contents have to decide."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 1)


def test_groups_and_clashing_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for digest in (sha256, weak, lambda text: F.lit("same")):
        found = duplicate_groups(docs, digest=digest)
        assert result(found) == brute(ROWS)
        # One row of each text stays, also where text and id repeat.
        assert found.where("kept").count() == len({r[1] or "" for r in ROWS})


def test_rows_that_stay_keep_their_columns(spark):
    kept = without_duplicates(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "TEXT2", "kept", "_digest"]
    rows = {(r.doc_id, r.TEXT2) for r in kept.collect()}
    assert rows == {(2, "x"), (3, None), (5, "x"), (6, "w"), (None, "x"), (7, "x")}


def test_normalised_text_and_empty_table(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = duplicate_groups(docs, normalise=F.lower).where("doc_id = 1").first()
    assert (found.keep_id, found.group_size) == (6, 4)
    assert duplicate_groups(docs.limit(0)).count() == 0
    assert without_duplicates(docs.limit(0)).count() == 0


def test_memberships_of_a_hot_text_are_spread(spark, monkeypatch):
    """With look-ups by shuffle, no task holds much of a text that a third of all rows have."""
    from fareflow.llm import exact_dedup
    from fareflow.operators.joins import lookup

    found = []

    def by_shuffle(*args):
        joined = lookup(*args, broadcast_bytes=0, hot_rows=100)
        found.append(sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()))
        return joined

    monkeypatch.setattr(exact_dedup, "lookup", by_shuffle)
    docs = spark.range(9000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        kept = duplicate_groups(docs).where("kept").count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert kept == 6001 and len(found[0]) == 4 and found[0][-1] < 2 * found[0][1]


def test_hot_text(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text")
    found = duplicate_groups(docs)
    assert found.count() == 5000
    assert found.where("group_size > 1").select("keep_id", "group_size").distinct().collect() == [(4998, 1667)]
