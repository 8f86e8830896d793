"""SentencePiece encoding and decoding for vocabularies of merge type.

A text is given the dummy prefix and its spaces become the space symbol. Its characters are symbols of a
linked list, and an agenda (a heap) holds all adjacent pairs whose joint string is a piece: the pair of the
highest score is merged first, of equal scores the leftmost. A merge puts its two new neighbouring pairs on the
agenda; entries whose symbols have changed meanwhile are skipped. What is left are the tokens; a symbol that
is no piece becomes its UTF-8 bytes.

No piece of the usual vocabularies holds the space symbol behind another character. Then no merge crosses the
border before a run of space symbols, the parts between such borders are independent of each other, and short
parts are remembered. Where a vocabulary has such a piece, the whole text is one part.

Check: the parts that an Arrow batch has and that are not remembered are given to the sentencepiece library, too;
a difference ends the job with an error.

Defined results: a null text is encoded as the empty text, to no ids. Strings that look like control or byte pieces
are ordinary text. The space symbol inside a text is decoded as a space, as the library does. Rows are
never merged: repeated ids and texts give a result each. Vocabularies with unused pieces or without byte
pieces are refused.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from fareflow.llm.common import arrow_map, pick

#: Fixed value: the symbol that stands for a space.
SPACE = "▁"
CACHED_PARTS = 1_200_000
CACHED_CHARS = 64
ROWS_AT_ONCE = 256


class PieceCodec:
    """Encoder and decoder for one model file."""

    def __init__(self, model_file: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(library.get_piece_size())
        if any(map(library.is_unused, ids)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(library.is_byte, self.byte_ids)):
            raise ValueError("the vocabulary has no byte pieces")
        byte_of = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        plain = [i for i in ids if not (i in byte_of or library.is_control(i) or library.is_unknown(i))]
        self.pieces = {library.id_to_piece(i): (-library.get_score(i), i) for i in plain}
        self.is_byte = [i in byte_of for i in ids]
        self.surface = [byte_of.get(i, b"") for i in ids]
        for piece, (_, i) in self.pieces.items():
            self.surface[i] = piece.encode()
        for i in filter(library.is_unknown, ids):
            self.surface[i] = library.decode([i]).encode()
        whole = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.cut = (lambda text: [text]) if whole else re.compile(f"{SPACE}+[^{SPACE}]*").findall
        self.known: dict[str, bytes] = {}

    def merged(self, part: str) -> list[int]:
        """The ids of one part, by the agenda."""
        score_of = self.pieces.get
        symbols = list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            if found := score_of(pair := symbols[i] + symbols[i + 1]):
                agenda.append((found[0], i, pair))
        heapify(agenda)
        while agenda:
            _, left, piece = heappop(agenda)
            own, right = symbols[left], after[left]
            # Strings only grow, so a pair is as it was if it still has the length of its piece.
            if not own or right == n or len(own) + len(symbols[right]) != len(piece):
                continue
            symbols[left], symbols[right] = piece, ""
            end = after[left] = after[right]
            if end < n:
                before[end] = left
                if found := score_of(pair := piece + symbols[end]):
                    heappush(agenda, (found[0], left, pair))
            start = before[left]
            if start >= 0 and (found := score_of(pair := symbols[start] + piece)):
                heappush(agenda, (found[0], start, pair))
        out: list[int] = []
        for symbol in filter(None, symbols):
            if found := score_of(symbol):
                out.append(found[1])
            else:
                out.extend(map(self.byte_ids.__getitem__, symbol.encode()))
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; new parts are checked with the library."""
        parts = [self.cut(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        new = list({p for own in parts for p in own}.difference(self.known))
        if len(self.known) + len(new) > CACHED_PARTS:
            self.known.clear()
            new = list({p for own in parts for p in own})
        ids = [self.merged(part) for part in new]
        self._check(new, ids)
        found = {p: pack(f"<{len(i)}i", *i) for p, i in zip(new, ids)}
        self.known.update((p, i) for p, i in found.items() if len(p) <= CACHED_CHARS)
        get = lambda p: self.known.get(p) or found[p]
        return [b"".join(map(get, own)) for own in parts]

    def _check(self, parts: list[str], ids: list[list[int]]) -> None:
        """The library puts the first space symbol there itself, so it cannot be asked for a lone one."""
        theirs = self.library.encode([p[1:] for p in parts], num_threads=1) if parts else []
        if ids != theirs:
            for part, own, other in zip(parts, ids, theirs):
                if own != other and part != SPACE:
                    raise ValueError(f"the sentencepiece library has other ids for {part[:200]!r}")

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control pieces are silent, bytes that are not UTF-8 become replacement characters."""
        joined = list(map(self.surface.__getitem__, ids))
        silent = b"" in joined
        first = next((k for k, data in enumerate(joined) if data), None)
        if first is not None and not self.is_byte[ids[first]]:
            joined[first] = joined[first].removeprefix(SPACE.encode())
        try:
            if not silent:  # else a control piece may stand between the bytes of a character
                return b"".join(joined).decode().replace(SPACE, " ")
        except UnicodeDecodeError:
            pass
        return self._decode_runs(ids, joined).replace(SPACE, " ")

    def _decode_runs(self, ids: list[int], joined: list[bytes]) -> str:
        out, run = [], b""
        for i, data in zip([*ids, None], [*joined, b""]):
            if i is not None and self.is_byte[i]:
                run += data
                continue
            while run:
                size = next((k for k in (1, 2, 3, 4) if _one_character(run[:k])), 0)
                out.append(run[:size].decode() if size else "�")
                run = run[size or 1:]
            out.append(data.decode())
        return "".join(out)


def _one_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


def encode_pieces(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, ids (array of int) and, decoded from them, decoded (string) for every row of ``docs``."""
    def work(batches):
        coder = codec(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                packed = coder.encode_all([text.as_py() or "" for text in part.column(1)])
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                ids = np.frombuffer(b"".join(packed), "<i4")
                texts = [coder.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])

    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    return arrow_map(docs, work, f"doc_id {docs.dtypes[0][1]}, ids array<int>, decoded string")
