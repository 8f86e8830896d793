import random
import re

import pytest
from pyspark.sql import functions as F

from fareflow.llm import mixing
from fareflow.llm.mixing import mix, mixed_documents, permuted, running_start
from fareflow.sources.tables import RunFolder

SCHEMA = "doc_id long, text string, source string, TAKEN string, place int, block int"


def rows(n, sources=7, seed=1):
    draw = random.Random(seed)
    out = [(i, " \t".join("w" for _ in range(draw.randrange(300))), draw.choice([None, *"éBaZ1b"][:sources]), "x", 1, 2)
           for i in range(n)]
    out += [(n, None, "a", "x", 1, 2), (n + 1, "", "only empty", "x", 1, 2), (None, "a b c", "B", "x", 1, 2),
            (3, "tie here", "B", "x", 1, 2), (3, "tie here", "B", "x", 1, 2), (n + 2, "w " * 60_000, "B", "x", 1, 2)]
    return out


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, total = set(order), {}, sum(sizes.values())
    while left:
        open_words = total - sum(target.values())
        over = [s for s in left if open_words * weight[s] / sum(weight[x] for x in left) > cap * sizes[s]]
        if not over:
            target |= {s: open_words * weight[s] / sum(weight[x] for x in left) for s in left}
            break
        for s in over:
            target[s] = cap * sizes[s]
        left -= set(over)
    return target


@pytest.mark.parametrize("sources", [2, 7])
def test_targets_sizes_and_limits(spark, sources):
    data = rows(400, sources)
    docs = spark.createDataFrame(data, SCHEMA)
    found = mix(docs)
    got = found.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size, str(r.source)) for r in got) == sorted((str(d), size(t), str(s)) for d, t, s, *_ in data)
    sizes = {}
    for _, text, source, *_ in data:
        sizes[source] = sizes.get(source, 0) + size(text)
    target = plain_targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, words in taken.items():
        assert target[source] - 1 - 1e-6 <= words <= target[source] + 1e-6
    key = lambda df: sorted(map(str, df.collect()))
    assert key(mix(docs)) == key(found)


def test_pieces_do_not_change_the_rules(spark, monkeypatch):
    for name, value in (("SHARD_SLOTS", 16), ("CHUNK_ROWS", 5), ("CHUNK_SLOTS", 7)):
        monkeypatch.setattr(mixing, name, value)
    data = rows(300)
    for r in (totals := mix(spark.createDataFrame(data, SCHEMA)).groupBy("source").agg(
            F.sum("taken").alias("taken"), F.max("target").alias("target"), F.expr("max(try_divide(taken, size))").alias("most")).collect()):
        assert -1e-6 <= r.target - r.taken <= 1 + 1e-6 and (r.most or 0) <= 3
    assert len(totals) == 8


@pytest.mark.parametrize("seed", [1, 2])
def test_small_sources_reach_their_targets(spark, seed):
    """One large source, many of a few words and some of little more than a block."""
    draw = random.Random(seed)
    data = [(i, "w " * 1000, "big") for i in range(100)]
    data += [(1000 + i, "a b c", f"tiny{i:02d}") for i in range(12)]
    data += [(2000 + 2 * i + j, "w " * 35, f"small{i}") for i in range(8) for j in range(2)]
    draw.shuffle(data)
    found = mix(spark.createDataFrame(data, "doc_id long, text string, source string"))
    for r in found.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(
            F.col("taken") / F.col("size")).alias("most")).collect():
        assert 0 <= r.target + 1e-6 - r.taken < 1 + 1e-5 and r.most <= 3


def plain_taken(rows, sources, slots, order_of):
    """The words taken of every row, from the drawn slots: whole streams of words, block by block."""
    out = []
    for s in sources:
        stream = [i for i, r in rows if r.source == s.source for _ in range(r.size)]
        count, blocks, owed = {}, [stream[at:at + mixing.BLOCK] for at in range(0, len(stream), mixing.BLOCK)], int(s.target)
        mine = sorted(x.slot for x in slots if x.place == s.place)
        assert mine == list(range(s.n_slots))
        for slot in mine:
            turn, at = divmod(slot, len(blocks))
            words = blocks[order_of(s.place, turn, len(blocks))[at]][:owed]
            owed -= len(words)
            for i in words:
                count[i] = count.get(i, 0) + 1
        out += [(i, count.get(i, 0)) for i, r in rows if r.source == s.source]
    return dict(out)


def test_against_whole_streams(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    docs = spark.createDataFrame(rows(120), SCHEMA).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text", "source")
    run = RunFolder(spark)
    found = mix(docs).collect()
    sized = spark.createDataFrame([(r.doc_id, r.source, r.size) for r in found], "doc_id long, source string, size long")
    sources = mixing.source_table(sized, (5, 2, 1), 3, run)
    slots = mixing.drawn_slots(sources, run).collect()
    by_shard = {}
    for x in slots:
        by_shard[x.shard] = by_shard.get(x.shard, 0) + 1
    assert sorted(by_shard.values(), reverse=True)[:-1] == [16] * (len(by_shard) - 1) and len(by_shard) > 5
    known = {}

    def order_of(place, turn, n):
        if (place, turn) not in known:
            key = F.pmod(F.xxhash64(F.lit(place).cast("long"), F.lit(turn).cast("long")), F.lit(1 << 30))
            known[place, turn] = [r.x for r in spark.range(n).coalesce(1).select(permuted(F.col("id"), F.lit(n), key).alias("x")).collect()]
        return known[place, turn]

    # The stream of a source has its documents in the order of chunks and ids; small sources are one chunk.
    ordered = sorted(enumerate(found), key=lambda x: x[1].doc_id)
    taken = plain_taken(ordered, [s for s in sources.collect() if s.source_size], slots, order_of)
    assert {i: r.taken for i, r in enumerate(found) if r.size} == {i: n for i, n in taken.items() if found[i].size}


def test_permutation(spark):
    for size in (1, 2, 3, 64, 65, 1000):
        for key in (0, 123_456_789):
            found = [r.x for r in spark.range(size).select(permuted(F.col("id"), F.lit(size), F.lit(key)).alias("x")).collect()]
            assert sorted(found) == list(range(size))
    big = spark.range(2000).select(permuted(F.col("id"), F.lit(2 ** 39 + 1), F.lit(77)).alias("x"))
    assert big.where("x < 0 OR x > 549755813888").count() == 0 and big.distinct().count() == 2000


def test_running_start(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 3)
    df = spark.createDataFrame([(k, i, i % 4, 50) for k in (1, 2) for i in range(50)], "k int, i int, size int, n int")
    for k in (1, 2):
        found = sorted((r._start, r.size) for r in running_start(df, ["k"], ["i"], "size", "n").where(f"k = {k}").collect())
        ends = sorted(s + n for s, n in found)
        assert ends[-1] == sum(i % 4 for i in range(50)) and sum(n for _, n in found) == ends[-1]
        covered = [x for s, n in found for x in range(s, s + n)]
        assert sorted(covered) == list(range(ends[-1]))


def test_documents_as_often_as_taken(spark):
    docs = spark.createDataFrame(rows(300), SCHEMA)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.taken / r.size for r in mix(docs).where("size > 0").collect()}
    for r in mixed.where("size(split(text, ' ')) > 1 AND doc_id <> 3").groupBy("doc_id").count().collect():
        assert abs(r["count"] - taken[r.doc_id]) < 1


def test_empty_tables(spark):
    docs = spark.createDataFrame(rows(3), SCHEMA)
    assert mix(docs.limit(0)).count() == 0 and mixed_documents(docs.limit(0)).count() == 0
    silent = docs.withColumn("text", F.lit(None).cast("string"))
    assert mix(silent).where("taken > 0 OR target > 0").count() == 0
    assert RunFolder(spark) is not None


def test_no_python_in_the_plan(spark):
    docs = spark.sql("SELECT id AS doc_id, 'a b c' AS text, 'x' AS source FROM range(100)")
    text = mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
