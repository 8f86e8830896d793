import random

import numpy as np
import pytest

from fareflow.llm.chat import chat_tokenizer, escape, format_conversations, loss_mask, parse, render, unescape

vocabularies = pytest.importorskip("public_tokenizers")
MODEL = vocabularies.path("byte_bpe_50k.json")
PIECES = ["<|im_end|>", "<|im_start|>assistant ", "<", "|", "\\", "\\|", "<\\|", "\n", " ", "", "é😀", "word.", "<|im_sep|>",
          "<|endoftext|>", "   ", "assistant"]


def test_escaping_can_be_undone():
    draw = random.Random(1)
    for _ in range(2000):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(12)))
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        turns = [(draw.choice(["user", "assistant", text]), text), ("assistant", text[::-1])]
        assert parse(render(turns).text) == turns


def test_binary_search_is_plain_containment():
    draw = np.random.default_rng(2)
    for _ in range(200):
        cuts = np.unique(draw.integers(0, 60, 25))
        offsets = np.stack([cuts[:-1], cuts[1:]], axis=1)
        spans = np.sort(draw.choice(cuts, 6, replace=False)).reshape(-1, 2)
        plain = [any(s <= a and b <= e for s, e in spans.tolist()) for a, b in offsets.tolist()]
        assert loss_mask(offsets, spans[:, 0], spans[:, 1]).tolist() == plain


def test_conversations(spark):
    draw = random.Random(3)
    rows, expected = [], {}
    for conv in [None, -1, *range(40)]:
        turns = [(t, draw.choice(["user", "assistant", "system"]), "".join(draw.choice(PIECES) for _ in range(draw.randrange(9))))
                 for t in range(draw.randrange(1, 9))]
        turns.append((turns[-1][0], "assistant", None))  # a tie and a null
        turns += [(99, "assistant", "same"), (99, "assistant", "same"), (100, None, "x" * 300)]
        rows += [(conv, *t, "extra") for t in turns]
        expected[conv] = [(r or "", x or "") for _, r, x in sorted(turns, key=lambda t: (t[0], t[1] or "", t[2] or ""))]
    rows.append((50, 0, "assistant", "long text " * 100_000, "extra"))
    expected[50] = [("assistant", "long text " * 100_000)]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, TURNS string")
    found = {r.conv_id: r for r in format_conversations(docs, MODEL).collect()}
    assert set(found) == set(expected)
    tokenizer = chat_tokenizer(MODEL)
    for conv, turns in expected.items():
        row = found[conv]
        assert [tuple(t) for t in row.turns] == turns
        assert row.loss_texts == [x for r, x in turns if r == "assistant" and x]
        assert len(row.ids) == len(row.mask) and tokenizer.decode(row.ids, skip_special_tokens=False) == row.formatted
        learned = tokenizer.decode([i for i, m in zip(row.ids, row.mask) if m])
        assert learned == "".join(escape(x) for r, x in turns if r == "assistant")
    assert format_conversations(docs.limit(0), MODEL).count() == 0
