"""Both BPE operators against the libraries whose results they reproduce."""

import hashlib
import random

import numpy as np
import pytest

from fareflow.llm.bpe_count import MergeCounter, counter, token_counts
from fareflow.llm.bpe_encode import codec, encode_documents

vocabularies = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")

RANKS, MODEL = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.path("byte_bpe_50k.json")
PATTERN = vocabularies.PATTERN
FIXED = ["", " ", "  \n\t ", "a" * 5000, "ab" * 3000, "I'll we'VE 12³ ١٢", "<|endoftext|>x<|endoftext|><|endoftext|>",
         "é́ 😀‍👩 ​\u0085 　.", "!!!???...,,,", "\x00\x1c\x7f", "word " * 4000]


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec(RANKS, PATTERN).ranks, special_tokens={})


def texts(n, seed):
    draw = random.Random(seed)
    letters = "aab the ingé\n\t 0123 's'll'VE ß世界😀.,!<|endoftext|>"
    for _ in range(n):
        if draw.random() < 0.3:
            yield "".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(128, 0x3000),
                                           draw.randrange(0x10000, 0x1F900)])) for _ in range(draw.randrange(60)))
        else:
            yield "".join(draw.choice(letters) for _ in range(draw.randrange(120)))


def test_ids_are_those_of_the_library(encoding):
    own = codec(RANKS, PATTERN)
    for text in [*FIXED, *texts(1500, 1)]:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_compatible_pairs_are_those_that_encode_to_themselves(encoding):
    own, draw = codec(RANKS, PATTERN), random.Random(3)
    ids = [i for i, t in enumerate(own.tokens) if t.isalpha()]
    for _ in range(3000):
        left, right = draw.choice(ids), draw.choice(ids)
        whole = own.tokens[left] + own.tokens[right]
        assert own.compatible(left, right) == (encoding.encode_ordinary(whole.decode()) == [left, right])


def test_counts_are_those_of_the_library():
    own, library = counter(MODEL, PATTERN), tokenizers.Tokenizer.from_file(MODEL)
    for text in [*FIXED, *texts(1500, 2)]:
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_cache_may_be_cleared_within_a_text(monkeypatch):
    monkeypatch.setattr("fareflow.llm.bpe_count.CACHED_PIECES", 3)
    monkeypatch.setattr("fareflow.llm.bpe_encode.CACHED_PIECES", 3)
    text = "one two three four five six one two seven"
    assert MergeCounter(MODEL, PATTERN).count(text) == 9
    own = codec(RANKS, PATTERN)
    assert own.decode(own.encode(text)) == text.encode()


def test_queries(spark, encoding):
    rows = [(i, t, "x", 1) for i, t in enumerate([*FIXED, None, "hi " * 300_000])] + [(None, "tie", "x", 1), (None, "tie", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string, ids int")
    digest = lambda b: hashlib.sha256(b).hexdigest()
    expected = sorted(((i, digest(np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()),
                        digest((t or "").encode())) for i, t, *_ in rows), key=str)
    found = encode_documents(docs, RANKS, PATTERN).collect()
    assert sorted(((r.doc_id, digest(r.ids), digest(r.decoded)) for r in found), key=str) == expected
    counts = {r.doc_id: r for r in token_counts(docs, MODEL, PATTERN, limit=512).collect()}
    assert counts[6].n_tokens == 4 and counts[10].over_limit and not counts[0].over_limit
    assert counts[7].n_bytes == len(FIXED[7].encode()) and counts[11].n_bytes == 0
    assert encode_documents(docs.limit(0), RANKS, PATTERN).count() == 0
    assert token_counts(docs.limit(0), MODEL, PATTERN, limit=1).count() == 0
