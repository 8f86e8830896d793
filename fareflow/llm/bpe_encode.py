"""Byte-level BPE encoding and decoding by longest matches and backtracking.

A piece (one match of the split pattern) is mapped byte by byte to Latin-1, and an Aho-Corasick
automaton over the vocabulary gives the longest token that starts at a place. Tokens are laid
from the left. Two neighbours are compatible when the merge order would indeed leave a border
between them; that is decided once for each pair and remembered. Where neighbours are
incompatible the next shorter token is tried, and where none is left the last token is taken back.
A place from which no way led on is not tried again, so the work is linear in the piece. The
result is exactly that of the merges in rank order.

Defined results: a null text is encoded as the empty text, to no ids. Strings of special tokens are
ordinary text. Rows are never merged: repeated ids and texts give a result each.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fareflow.llm.common import arrow_map, pick

CACHED_PIECES = 300_000
CACHED_PAIRS = 1_000_000
ROWS_AT_ONCE = 256


class BytePairCodec:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.find = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        self.parts = {rank: self._split(token) for token, rank in ranks.items()}
        self.merged = {pair: rank for rank, pair in self.parts.items() if pair[0] != rank}
        self.shorter = {rank: self._longest_prefix(token) for token, rank in ranks.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}

    def _split(self, token: bytes) -> tuple[int, int]:
        """The two tokens whose merge makes this one; a token that no merge makes is its own parts."""
        own = self.ranks[token]
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
            if rank >= own:
                return own, own
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (own, own)

    def _longest_prefix(self, token: bytes) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        for end in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:end])) is not None:
                return rank
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging in rank order leaves the border between these two neighbours.

        The merges that made both tokens are undone from the latest to the earliest. A token made of
        the two parts that face each other at the border would have come first if its rank is lower
        than the merge just undone.
        """
        key = (left, right)
        if (known := self.fits.get(key)) is not None:
            return known
        undone, fits = len(self.tokens), True
        while True:
            if self.merged.get((left, right), undone) < undone:
                fits = False
                break
            inner_left, inner_right = self.parts[left][1], self.parts[right][0]
            whole_left, whole_right = inner_left == left, inner_right == right
            if whole_left and whole_right:
                break
            # Of equal ranks the left merge happens first, so the right one is undone first.
            if whole_left or (not whole_right and right >= left):
                undone, right = right + 1, inner_right
            else:
                undone, left = left, inner_left
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def encode_piece(self, piece: bytes) -> list[int]:
        if (rank := self.ranks.get(piece)) is not None:
            return [rank]
        size, tokens, shorter = len(piece), self.tokens, self.shorter
        longest = self._longest_at(piece)
        dead = bytearray(size + 1)
        laid: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + len(tokens[token])
            if not dead[end] and (not laid or self.compatible(laid[-1], token)):
                laid.append(token)
                if end == size:
                    return laid
                at, token = end, longest[end]
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: take the last token back and shorten it
                dead[at] = 1
                token = laid.pop()
                at -= len(tokens[token])
                token = shorter[token]

    def _longest_at(self, piece: bytes) -> list[int]:
        longest = [-1] * len(piece)
        # Matches come by their end, so the last one with some start is the longest one there.
        for end, (back, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = rank
        return longest

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        pieces = self.find(text)
        known = self.pieces
        new = set(pieces).difference(known)
        if len(known) + len(new) > CACHED_PIECES:
            known.clear()
            new = set(pieces)
        for piece in new:
            known[piece] = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(rank_file: str, pattern: str) -> BytePairCodec:
    return BytePairCodec(rank_file, pattern)


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, ids (binary: packed little-endian unsigned 32-bit integers) and, decoded from them, decoded (binary)."""
    def work(batches):
        coder = codec(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = [coder.encode(text.as_py() or "") for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(map(coder.decode, ids), pa.binary())],
                    ["doc_id", "ids", "decoded"])

    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    return arrow_map(docs, work, f"doc_id {docs.dtypes[0][1]}, ids binary, decoded binary")
