import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fareflow.llm import lexical
from fareflow.llm.lexical import ImpactLists, search, terms

DOCS = "doc_id long, text string, ITEM string, n int, rank int, score string"
ITEMS = "item_id long, text string, TERM string, doc_id int"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(TERM, text or "")]


def plain(docs, items, k):
    texts = [(d, Counter(split(t))) for d, t, *_ in docs]
    texts = [(d, c, c.total()) for d, c in texts if c]
    n_docs, n_terms = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    asked = {}
    for item, text, *_ in items:
        asked.setdefault(item, Counter()).update(split(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for d, c, n in texts:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, times in wanted.items() if t in c)
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def data(seed=1):
    draw = random.Random(seed)
    words = [*"abcdefghijklmnop", "Éa", "中文", "x9", "THE", "the", "of"]
    text = lambda most: draw.choice([" ", ", ", "\x00", "　 "]).join(draw.choices(words, [1 + i for i in range(22)], k=draw.randrange(most)))
    docs = [(i, text(60)) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "... !"), (None, "a the"), (None, "a the"), (3, "a b"), (3, "a b"), (2000, "of Of " * 30_000 + "a")]
    docs += [(i, "same words here a b c") for i in range(3000, 3030)]
    items = [(i, text(25)) for i in range(25)] + [(50, None), (51, "unknown"), (52, ""), (None, "a c"), (9, "b the The"), (60, "same here")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "x", 1, 2, "s") for d in docs], DOCS),
            spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS))


@pytest.mark.parametrize("shard,block", [(10 ** 6, 10 ** 6), (40, 60)])
def test_against_plain_scores(spark, monkeypatch, shard, block):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", shard)
    docs, items = data()
    for k in (1, 10):
        found = search(*frames(spark, docs, items), k=k, block_terms=block)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, found.collect()), key=str) == plain(docs, items, k)


def test_string_ids(spark):
    docs, items = frames(spark, [(1, "a b"), (2, "b c")], [(1, "c")])
    found = search(docs, items.withColumn("item_id", items["item_id"].cast("string")))
    assert [(r.item_id, r.rank, r.doc_id) for r in found.collect()] == [("1", 1, 2)]


def test_empty_tables(spark):
    docs, items = frames(spark, *data())
    assert search(docs.limit(0), items).count() == 0 and search(docs, items.limit(0)).count() == 0
    assert search(docs.where("doc_id IN (1000, 1001)"), items).count() == 0


def test_terms():
    text = "The cAt9's ÉTÉ_中文\x7f<x> "
    assert [t.decode() for t in terms(text.encode())] == split(text) == ["the", "cat9", "s", "ÉtÉ", "中文", "x", " "]
    assert terms(None) == terms(b"") == []


def lists(rows):
    ends = np.cumsum([0, *map(len, rows)])
    flat = [p for r in rows for p in sorted(r)]
    return ImpactLists(ends, np.array([t for t, _ in flat], np.int32), np.array([v for _, v in flat], np.int64))


def test_search_of_lists():
    draw = random.Random(4)
    for _ in range(300):
        rows = [{t: draw.randrange(1, 9) for t in range(12) if draw.random() < draw.choice([0.2, 0.7])}.items() for _ in range(draw.randrange(1, 80))]
        index, dense = lists(rows), np.zeros(12, np.int64)
        asked = draw.sample(range(12), draw.randrange(1, 6))
        weight = {t: draw.randrange(5) for t in asked}
        scores = [sum(weight.get(t, 0) * v for t, v in r) for r in rows]
        k, floor = draw.randrange(1, 6), draw.choice([0, 0, 10, 25])
        docs, got = index.search(np.array(sorted(asked)), np.array([weight[t] for t in sorted(asked)]), dense, k, floor)
        least = max(floor, 1, sorted(scores)[-k] if len(scores) >= k else 0)
        assert not dense.any() and sorted(zip(docs.tolist(), got.tolist())) == [(d, s) for d, s in enumerate(scores) if s >= least]


def test_search_ends_early():
    """One document leads both lists; the bound at the best positions falls below it after a few accesses."""
    rows = [[(0, 1000 if i == 5 else 1 + i % 3), (1, 1000 if i == 5 else 1 + i % 2)] for i in range(10_000)]
    index = lists(rows)
    docs, scores = index.search(np.array([0, 1]), np.array([2, 3]), np.zeros(2, np.int64), 1, 0)
    assert docs.tolist() == [5] and scores.tolist() == [5000] and index.n_scored < 20
    # Equal scores are all of interest, since an id decides between them.
    docs, _ = index.search(np.array([0, 1]), np.array([1, 1]), np.zeros(2, np.int64), 2, 0)
    assert len(docs) == 1 + sum(i % 3 == 2 and i % 2 == 1 for i in range(10_000) if i != 5)
