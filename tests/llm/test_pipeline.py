"""Each stage of the pipeline on its own input, against plain Python."""

import os

import numpy as np
import pytest

from corpus_pipeline import STAGES, pipeline_oracles, run
from fareflow.llm.line_quality import judge, train
from fareflow.llm.mixing import mix
from fareflow.sources.tables import RunFolder

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def outputs(spark):
    folder, docs = RunFolder(spark), spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for i, (_, stage) in enumerate(STAGES):
        found.append(folder.write(f"s{i}", stage(spark, found[-1], FOLDER)))
    return found


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[:5]) and pipeline_oracles() == {}


def test_quality(spark, outputs):
    chain = train(outputs[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert rows(outputs[1]) == sorted((r for r in rows(outputs[0]) if judge(chain, r[1], 0.5)[6]), key=str)
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    plain = {r[0] for r in rows(outputs[0]) if not judge(chain, r[1], 0.5)[5]}
    assert good & plain <= {r[0] for r in rows(outputs[1])}


def test_exact_dedup(outputs):
    last = {}
    for r in rows(outputs[1]):
        last[r[1]] = max(last.get(r[1], r), r, key=lambda x: x[0])
    assert rows(outputs[2]) == sorted(last.values(), key=str)


def test_near_dedup(outputs):
    words = {r[0]: r[1].lower().split() for r in rows(outputs[2])}
    sets = {d: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for d, w in words.items()}
    boss = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                x, y = sorted((boss[a], boss[b]))
                boss = {d: x if c == y else c for d, c in boss.items()}
    assert {r[0] for r in rows(outputs[3])} == {d for d, c in boss.items() if d == c}


def test_mixing(outputs):
    ratio = {r.doc_id: r.taken / r.size for r in mix(outputs[3]).collect()}
    count = {}
    for r in rows(outputs[4]):
        count[r[0]] = count.get(r[0], 0) + 1
    assert all(abs(count.get(d, 0) - x) < 1 for d, x in ratio.items()) and set(count) <= set(ratio)


def test_encoding(outputs):
    tiktoken, vocabularies = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    from fareflow.llm.bpe_encode import codec

    ranks = codec(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r[0]: r[1] for r in rows(outputs[4])}
    found = outputs[5].collect()
    assert len(found) == outputs[4].count()
    for r in found:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) // 4


ODD = "doc_id long, text string, lang string, source string, n_chars long, _c0 string, _dropped long, size int, block long, place int"


def odd_rows():
    words = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(words[i:i + 40]), "en", "ab"[i % 2]) for i in range(30)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (None, " ".join(words[50:90]) + " x", "en", None), (None, None, None, None),
             (3, " ".join(words[200:240]), "en", "b"), (3, " ".join(words[3:43]), "en", "b"), (5, rows[5][1], "en", "b"),
             (200, "\n".join(f"line number{i} has its own words{i * 7} here" for i in range(30_000)), "en", "c"),
             (300, rows[7][1], "fr", None), (301, rows[7][1].upper(), "fr", "")]
    return [(*r, len(r[1] or ""), "d", 1, 2, 3, 4) for r in rows]


def test_odd_rows_pass_every_stage(spark):
    """Null texts, ids and sources, repeated ids and rows, a very long text, and columns with names used inside."""
    docs = spark.createDataFrame(odd_rows(), ODD)
    folder, found = RunFolder(spark), [docs]
    for i, (_, stage) in enumerate(STAGES):
        found.append(folder.write(f"odd{i}", stage(spark, found[-1], FOLDER)))
        if i < 4:
            assert found[-1].columns == docs.columns
    judged = found[1].collect()
    assert all(r.text for r in judged) and {r.doc_id for r in judged} >= {0, 3, 5, 200, None}
    assert len({r.text for r in judged}) == len({r.text for r in found[2].collect()}) == found[2].count()
    near = {r.doc_id for r in found[3].collect()}
    assert None in near and 200 in near and not {300, 301} & near
    assert found[5].count() == found[4].count() > 0


def test_each_stage_takes_what_the_first_one_drops(spark):
    """Every stage by itself, over all odd rows."""
    docs = spark.createDataFrame(odd_rows(), ODD)
    assert STAGES[1][1](spark, docs, FOLDER).count() == len({r[1] or "" for r in odd_rows()})
    near = STAGES[2][1](spark, docs, FOLDER)
    assert near.columns == docs.columns and near.where("doc_id IS NULL OR doc_id IN (100, 101)").count() == 4
    mixed = STAGES[3][1](spark, docs, FOLDER)
    assert mixed.columns == docs.columns and mixed.where("doc_id IN (100, 101)").count() == 2
    assert STAGES[4][1](spark, docs, FOLDER).where("doc_id = 100 AND n_tokens = 0").count() == 1


def test_empty_table_passes_every_stage(spark):
    docs = spark.createDataFrame([], ODD)
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0 and (i == 4 or out.columns == docs.columns)


def test_run(spark, outputs):
    assert sorted((r.doc_id, bytes(r.ids)) for r in run(spark, FOLDER).collect()) == sorted(
        (r.doc_id, bytes(r.ids)) for r in outputs[5].collect())
