import numpy as np

from fareflow.llm import line_dedup
from fareflow.llm.line_dedup import PerfectHash, Shard, drop_repeated_lines

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_chars, min_docs):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [line for line in lines if len(k := key(line)) < min_chars or len(holders[k]) < min_docs
                or max(holders[k]) == (-1 if doc is None else doc)]
        result.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(result, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 64, 20_000, np.uint64))
    places = PerfectHash.build(keys).places(keys)
    assert sorted(places.tolist()) == list(range(len(keys)))


def test_shard_knows_its_lines_only():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2 ** 64, 4000, np.uint64) for _ in range(2))
    shard = Shard.unpack(Shard.build(a[:2000], b[:2000], np.arange(2000, dtype=np.int32), np.arange(2000)).pack())
    held, last = shard.last_docs(a, b)
    assert held.tolist() == [True] * 2000 + [False] * 2000 and last.tolist() == list(range(2000))
    empty = np.zeros(0, np.uint64)
    none = Shard.build(empty, empty, np.zeros(0, np.int32), np.zeros(0, np.int64))
    assert not Shard.unpack(none.pack()).last_docs(a, b)[0].any()


def test_against_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(3)
    lines = [f"{'É' if i % 2 else 'Line'} {i} " + "x" * (30 + i) for i in range(12)] + ["", "short", " \t "]
    rows = []
    for doc in range(60):
        picked = [lines[i] for i in draw.integers(0, len(lines), 6)]
        picked = [p.upper() if draw.random() < 0.2 else f"\t {p} \r" if draw.random() < 0.3 else p for p in picked]
        rows.append((doc, "\n".join(picked)))
    rows += [(3, "\n".join(lines)), (None, "\n".join(lines)), (None, None), (70, ""), (71, "\n\n"), (72, None),
             (73, ("y" * 200_000 + "\n") * 3), *[(80 + i, "y" * 200_000) for i in range(6)], (90, lines[0]), (90, lines[0])]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, _A int, n_lines string")
    assert result(drop_repeated_lines(docs, 40, 5)) == brute(rows, 40, 5)
    # Many shards, and many copies of each.
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", 3)
    assert result(drop_repeated_lines(docs, 40, 5)) == brute(rows, 40, 5)
    assert result(drop_repeated_lines(docs, 40, 5_000)) == brute(rows, 40, 5_000)
    assert drop_repeated_lines(docs.limit(0), 40, 5).count() == 0
