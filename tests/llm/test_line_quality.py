import os
import random

import numpy as np
import pytest

from fareflow.llm.line_quality import (
    Chain, N_FEATURES, TRAIN_LINES, TRAIN_PARTS, emissions, fit, good_documents, judge, judge_documents, marginals, measure, repeated,
    some_lines, train, viterbi)

BLANK = " \t\n\x0b\x0c\r"
FOLDER = "/root/testdata/sf0.1"


def plain_counts(text):
    split = lambda t: "".join(" " if c in BLANK else c for c in t).split(" ")
    words = [w for w in split(text) if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if any(split(line)) and line in lines[:i])
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))


def test_counts_are_those_of_the_plain_rule():
    draw = random.Random(1)
    texts = ["", "\n\n", " \t", "é é é é é é\x1c", "a b c d e\n" * 7, "#" * 50]
    texts += ["".join(draw.choice("ab \n\t|é<\x0b") for _ in range(draw.randrange(150))) for _ in range(400)]
    for text in texts:
        assert tuple(measure(text)[0]) == plain_counts(text)
        assert measure(text)[2].shape == (text.count("\n") + 1, N_FEATURES)
    assert repeated(np.zeros(100_000, np.int64)).all()


def test_viterbi_is_the_best_of_all_paths():
    draw = np.random.default_rng(2)
    for _ in range(300):
        scores, stay = draw.normal(0, 2, draw.integers(1, 8)), draw.normal(0, 2)
        value = lambda p: sum(s for s, y in zip(scores, p) if y) + stay * sum(a == b for a, b in zip(p, p[1:]))
        paths = [[bool(i >> k & 1) for k in range(len(scores))] for i in range(2 ** len(scores))]
        assert abs(value(viterbi(scores, stay).tolist()) - max(map(value, paths))) < 1e-9


def test_marginals_are_those_of_all_paths():
    draw = np.random.default_rng(3)
    scores, stay = draw.normal(0, 1, (1, 6)), 0.7
    real = np.array([[True] * 5 + [False]])
    paths = [[i >> k & 1 for k in range(5)] for i in range(32)]
    mass = np.array([np.exp(np.dot(scores[0, :5], p) + stay * sum(a == b for a, b in zip(p, p[1:]))) for p in paths])
    content, same = marginals(scores, stay, real)
    assert np.allclose(content[0, :5], mass @ np.array(paths) / mass.sum())
    assert np.isclose(same[0], mass @ [sum(a == b for a, b in zip(p, p[1:])) for p in paths] / mass.sum())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    chain = train(docs, labels.where("doc_id % 2 = 0"))
    held = judge_documents(docs, chain).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in held) / len(held) > 0.97
    good = [r for r in held if r.quality == 1]
    assert sum(r.kept for r in good) / len(good) > 0.99


def prose(draw):
    return " ".join("".join(draw.choice("aeioulmnrst") for _ in range(draw.randrange(2, 9))) for _ in range(draw.randrange(6, 14))) + "."


def junk(draw):
    return " ".join(draw.choice(["|", "#", "%%", "$ 9", "&&", "<>", "404", "12*", "***", "A!"]) for _ in range(draw.randrange(3, 9)))


def test_mixed_documents_have_mixed_states():
    """Labels belong to whole documents, some of whose lines are of the other kind."""
    draw, texts, labels, kinds = random.Random(6), [], [], []
    for i in range(240):
        good, state, own = i % 2, i % 2, []
        for _ in range(draw.randrange(8, 30)):
            state = (1 - state) if draw.random() < (0.1 if state == good else 0.4) else state
            own.append(state)
        texts.append("\n".join(prose(draw) if s else junk(draw) for s in own))
        labels.append(good)
        kinds.append(np.array(own, bool))
    chain = fit([measure(t)[2] for t in texts[:160]], labels[:160])
    decoded = [viterbi(emissions(chain, measure(t)[2]), chain.stay) for t in texts[160:]]
    right = np.concatenate([d == k for d, k in zip(decoded, kinds[160:])])
    assert right.mean() > 0.95
    assert sum(0 < d.sum() < len(d) for d in decoded) > 0.9 * sum(0 < k.sum() < len(k) for k in kinds[160:])
    assert 0 < chain.stay < 10


def test_training_takes_a_bounded_part_of_a_document(spark):
    many = np.arange(100_000.0)[:, None] + np.zeros(N_FEATURES)
    assert len(some_lines(many)) == TRAIN_PARTS * TRAIN_LINES and len(some_lines(many[:70])) == 70
    assert some_lines(many)[0, 0] == 0 and some_lines(many)[-1, 0] == 99_999
    # A labelled id that many rows share is one document.
    docs = spark.range(3000).selectExpr("id % 2 AS doc_id", "concat('plain words of row ', id, ' and more of them follow here') AS text")
    labels = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (1, None)], "doc_id long, quality int")
    assert train(docs, labels).spread.shape == (N_FEATURES,)


def test_documents(spark):
    good, bad = "Plain words stand here in a row.\nAnd some more of them follow.", "A! %% #1 | |\n" * 3 + "q ## 77 | x1 $$ z9 && k2 ** m3"
    rows = [(i, t, y) for i, (t, y) in enumerate([(good + f" number{i}", 1) for i in range(30)] + [(bad + f" {i}", 0) for i in range(30)])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, quality int, KEPT string")
    labels = docs.select("doc_id", "quality").unionByName(spark.sql("SELECT 1L AS doc_id, CAST(NULL AS INT) AS quality"))
    chain = train(docs, labels)
    extra = [(100, None, 1, "x"), (101, "", 1, "x"), (None, good, 1, "x"), (None, good, 1, "x"), (102, " \n" * 1000, 1, "x"),
             (103, "\n".join(f"word{i} runs on here" for i in range(60_000)), 1, "x")]
    both = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    found = judge_documents(both, chain).collect()
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        if r.doc_id in texts:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])
            assert r.kept == (r.doc_id < 30)
    kept = {r.doc_id: r.kept for r in found}
    assert not kept[100] and not kept[101] and not kept[102] and kept[None] and len(found) == 66
    left = good_documents(both, chain)
    assert left.columns == both.columns and left.count() == sum(r.kept for r in found)
    assert judge_documents(both.limit(0), chain).count() == 0 and good_documents(both.limit(0), chain).count() == 0
    untrained = train(docs, labels.limit(0))
    assert judge(untrained, bad, 0.5)[7] == 1.0 and isinstance(untrained, Chain)
    assert fit([], []).stay == 0.0 and emissions(untrained, np.zeros((2, N_FEATURES))).tolist() == [0, 0]
