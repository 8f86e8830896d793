"""Token counts by byte-pair merging over a heap and a linked list.

Each piece starts as one symbol per byte. The adjacent pair of lowest rank (leftmost of equal
ones) is popped from a heap and joined in the linked list, which offers up to two new pairs.
The count is the number of first symbols less the number of merges; no ids are made.

Defined results: a null text counts as the empty text, with no tokens. Strings of added tokens inside
a text count as one token each, as the library does by default. Every row gets a result.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.common import arrow_map, pick

CACHED_PIECES = 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class MergeCounter:
    def __init__(self, tokenizer_file: str, pattern: str):
        with open(tokenizer_file, encoding="utf-8") as file:
            content = json.load(file)
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        symbols: dict[str, int] = {}
        for letter in byte_letters():
            symbols[letter] = len(symbols)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            joined = symbols.setdefault(left + right, len(symbols))
            self.pairs[symbols[left], symbols[right]] = (rank, joined)
        added = [t["content"] for t in content["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.find = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def count_piece(self, piece: bytes) -> int:
        size = len(piece)
        symbol = list(piece)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pairs = self.pairs
        # An entry holds the two symbols it was made for, so that an outdated one is recognised.
        heap = [(found[0], i, symbol[i], symbol[i + 1], found[1]) for i in range(size - 1)
                if (found := pairs.get((symbol[i], symbol[i + 1])))]
        heapify(heap)
        merges = 0
        while heap:
            _, at, left, right, joined = heappop(heap)
            nxt = after[at]
            if symbol[at] != left or nxt >= size or symbol[nxt] != right:
                continue
            merges += 1
            symbol[at], symbol[nxt] = joined, -1
            after[at] = follow = after[nxt]
            if follow < size:
                before[follow] = at
                if found := pairs.get((joined, symbol[follow])):
                    heappush(heap, (found[0], at, joined, symbol[follow], found[1]))
            if (prior := before[at]) >= 0 and (found := pairs.get((symbol[prior], joined))):
                heappush(heap, (found[0], prior, symbol[prior], joined, found[1]))
        return size - merges

    def _count(self, text: str) -> int:
        pieces = self.find(text)
        known = self.known
        new = set(pieces).difference(known)
        if len(known) + len(new) > CACHED_PIECES:
            known.clear()
            new = set(pieces)
        for piece in new:
            known[piece] = self.count_piece(piece.encode())
        return sum(map(known.__getitem__, pieces))

    def count(self, text: str) -> int:
        if self.added is None or not self.added.search(text):
            return self._count(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._count, parts))


@lru_cache(maxsize=2)
def counter(tokenizer_file: str, pattern: str) -> MergeCounter:
    return MergeCounter(tokenizer_file, pattern)


def token_counts(
    docs: DataFrame, tokenizer_file: str, pattern: str, limit: int,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for every row."""
    def work(batches):
        merges = counter(tokenizer_file, pattern)
        for batch in batches:
            counts = [merges.count(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    docs = pick(docs, id_column, text_column).toDF("doc_id", "text").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return arrow_map(docs, work, f"doc_id {docs.dtypes[0][1]}, n_bytes bigint, n_tokens bigint").withColumn(
        "over_limit", F.col("n_tokens") > limit)
