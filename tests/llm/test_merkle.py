import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm import merkle
from fareflow.llm.merkle import TOP, build_manifest, octopus, proofs

COLUMNS = ["doc_id", "source", "lang", "text"]
SCHEMA = "doc_id long, source string, lang string, text string, ID string, tree int, LEAF string, n int"


def H(text):
    return sha256(text.encode()).hexdigest()


def leaf(values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def parents(level):
    return [H("".join(level[i:i + 16])) for i in range(0, len(level), 16)]


def path(level, at):
    """The siblings of a node on the way up, run by run, with the number of those to the left."""
    out = []
    while len(level) > 1:
        run = at // 16 * 16
        out.append((level[run:at], level[at + 1:run + 16]))
        level, at = parents(level), at // 16
    return out


def top(level):
    while len(level) > 1:
        level = parents(level)
    return level[0]


def plain(rows, shown):
    """(id, leaf, subroot, root, proof, folded root) of every row, from whole lists."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r[:4]), leaf(shown(r[:4])), r[0]))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(sources[s]) for s in order}
    subroots = [top([x[2] for x in trees[s]]) for s in order]
    out = []
    for place, s in enumerate(order):
        for at, x in enumerate(trees[s]):
            steps = path([y[2] for y in trees[s]], at) + path(subroots, place)
            folded = x[3]
            for left, right in steps:
                folded = H("".join(left) + folded + "".join(right))
            proof = "".join("".join(left + right) for left, right in steps)
            out.append((x[4], x[2], subroots[place], top(subroots), proof, folded, folded == top(subroots)))
    return sorted(out, key=str)


def table(spark, sizes, seed=1):
    draw, rows = random.Random(seed), []
    for source, n in sizes.items():
        rows += [(draw.randrange(10_000), source, draw.choice(["en", None]), draw.choice(["Some Text", "é" * 5, "", None, "low"]))
                 for _ in range(n)]
    rows += [rows[0], rows[0], (None, None, None, None), (None, "a", "x", "Y"), (7, "a", "x", "T"), (7, "a", "x", "S"),
             (8, "long", "x", "Very Long " * 20_000)]
    draw.shuffle(rows)
    return rows, spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def found(df):
    return sorted(map(tuple, df.select("id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


SIZES = [
    {"a": 1}, {"a": 15, None: 16, "b": 17}, {"é": 300, "Z": 40, "a": 1, "b": 1, "c": 5, "": 33},
    {f"s{i}": 1 + i % 3 for i in range(40)},
]


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize("part", [16, 4096])
def test_against_whole_lists(spark, sizes, part, monkeypatch):
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    rows, docs = table(spark, sizes)
    shown = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    own = lambda r: (*r[:3], r[3].lower() if r[0] is not None and r[0] % 3 == 0 and r[3] else r[3])
    manifest = build_manifest(docs, COLUMNS, presented={"text": shown})
    expected = plain(rows, own)
    assert found(proofs(manifest)) == expected
    # A subset of the leaves needs nodes of all levels, and gets the same proofs.
    asked = found(proofs(manifest, F.col("id") % 7 == 1))
    assert asked == [x for x in expected if x[0] is not None and x[0] % 7 == 1]
    roots = {r.tree: r.hash for r in manifest.roots().collect()}
    assert roots[TOP] == expected[0][3] and len(roots) == manifest.n_trees + 1


def test_octopus_is_the_least_set():
    draw = random.Random(2)
    for _ in range(200):
        sizes = [draw.randrange(1, 600) for _ in range(draw.randrange(1, 40))]
        leaves = sorted({(t, draw.randrange(sizes[t])) for t in draw.choices(range(len(sizes)), k=draw.randrange(1, 30))})
        trees, positions = map(np.array, zip(*leaves))
        got = {(t, lv, int(i)) for t, lv, some in octopus(trees, positions, np.array(sizes)[trees], len(sizes)) for i in some}
        expected = set()
        for tree, have, n in [*((t, {p for u, p in leaves if u == t}, sizes[t]) for t in {t for t, _ in leaves}),
                              (TOP, {t for t, _ in leaves}, len(sizes))]:
            level = 0
            while n > 1:
                expected |= {(tree, level, i) for p in have for i in range(p // 16 * 16, min(n, p // 16 * 16 + 16)) if i not in have}
                have, n, level = {p // 16 for p in have}, -(-n // 16), level + 1
        assert got == expected


def test_fetched_once_by_partition(spark):
    """Blocks of a large source lack nodes above their own alone, each coordinate once."""
    docs = spark.range(9000).selectExpr("id AS doc_id", "'s' AS source", "'x' AS lang", "'t' AS text")
    manifest = build_manifest(docs, COLUMNS)
    assert proofs(manifest).where("verified").count() == 9000
    missing = manifest.run.spark.read.parquet(manifest.run.path("missing"))
    assert missing.where("level < 3").count() == 0 and missing.count() == missing.distinct().count() == 2 * 3


def test_empty_and_single(spark):
    _, docs = table(spark, {"a": 1})
    empty = build_manifest(docs.limit(0), COLUMNS)
    assert proofs(empty).count() == 0 and empty.roots().count() == 0
    one = spark.createDataFrame([(5, "s", None, None)], "doc_id long, source string, lang string, text string")
    row = proofs(build_manifest(one, COLUMNS)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof == "" and row.verified
