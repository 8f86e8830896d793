"""Chat formatting with loss masks that are aligned by offsets.

A conversation is rendered as a whole and encoded once, with the offsets of its tokens. The turns'
texts are spans of the rendered string, sorted by nature, so two binary searches find the tokens
that lie in each. Control strings are tokens of their own, so no token crosses the end of a text.

Inside roles and texts a backslash is doubled and "<|" gets a backslash between its letters. No control
string is left in them, and the change can be undone.

Defined results: a null role or text counts as empty. Turns are ordered by turn, then role, then text;
repeated rows are turns of their own. Rows whose conv_id is null form one conversation. An assistant text
that is empty has no tokens and adds nothing to the loss.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, processors

from fareflow.llm.common import arrow_map, pick

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END), re.DOTALL)


class Rendered(NamedTuple):
    text: str
    starts: np.ndarray  # where the learned texts start in ``text``, ascending
    ends: np.ndarray


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\\|])", r"\1", text)


def render(turns: list[tuple[str, str]]) -> Rendered:
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{MIDDLE}", escape(text)
        if role == LEARNED:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return Rendered("".join(parts), np.array(starts, np.int64), np.array(ends, np.int64))


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns, read back from a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(rendered)]


@lru_cache(maxsize=2)
def chat_tokenizer(tokenizer_file: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.add_special_tokens([START, MIDDLE, END])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def loss_mask(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each token, whether it lies in one of the sorted spans."""
    steps = np.zeros(len(offsets) + 1, np.int64)
    first = np.searchsorted(offsets[:, 0], starts, "left")
    last = np.searchsorted(offsets[:, 1], ends, "right")
    kept = first < last
    np.add.at(steps, first[kept], 1)
    np.add.at(steps, last[kept], -1)
    return np.cumsum(steps[:-1]) > 0


def masked_texts(text: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped text under each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [unescape(text[offsets[a, 0]:offsets[b - 1, 1]]) for a, b in zip(edges[::2], edges[1::2])]


def format_conversations(
    rows: DataFrame, tokenizer_file: str, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """One row for each conversation: conv_id, formatted, ids (array of int) and mask (array of boolean),
    with what can be read back from them: turns (array of role and text) and loss_texts."""
    rows = pick(rows, id_column, turn_column, role_column, text_column).toDF("conv_id", "turn", "role", "text")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", *blank))).alias("turns"))
    talks = talks.select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"),
                         F.transform("turns", lambda t: t["text"]).alias("texts"))

    def work(batches):
        tokenizer = chat_tokenizer(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [render(list(zip(r, t))) for r, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                out = {"formatted": [], "ids": [], "mask": [], "turns": [], "loss_texts": []}
                for rendered in made:
                    encoded = tokenizer.encode(rendered.text, add_special_tokens=False)
                    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                    mask = loss_mask(offsets, rendered.starts, rendered.ends)
                    for name, value in zip(out, (
                            rendered.text, encoded.ids, mask.tolist(),
                            [{"role": r, "text": t} for r, t in parse(rendered.text)],
                            masked_texts(rendered.text, offsets, mask))):
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays([part.column(0), *(
                    pa.array(v, t) for v, t in zip(out.values(), (
                        pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()),
                        pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
                        pa.list_(pa.string()))))], ["conv_id", *out])

    return arrow_map(
        talks, work, f"conv_id {talks.dtypes[0][1]}, formatted string, ids array<int>, mask array<boolean>, "
        "turns array<struct<role: string, text: string>>, loss_texts array<string>")
