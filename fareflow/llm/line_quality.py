"""Quality rules: plain counts, and a linear-chain conditional random field over lines.

Each line is described by a few ratios. The chain has two states, boilerplate and content; its weights are
learned in numpy from a bounded sample of labelled documents. Labels belong to documents, so those of the lines are derived:
lines are told apart first, each for itself, by the labels of their documents; then a line that looks like those
of the other kind takes the other label, as a symbol-heavy line of a good document or a line of prose in a bad one. The
chain is trained on these, which teaches it how states change. Viterbi decoding marks the lines of every document. A
document is kept if it passes the base rules and at least half of its words stand in content lines.

Defined results: a null text counts as empty, without words, and fails the base rules. Ties in decoding go
to content. Without labelled documents of both kinds every line is content. Rows that repeat get a result
each; of labels that repeat for an id the largest counts, and of rows that repeat a labelled id the smallest text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.common import arrow_map, numbered, pick

TRAIN_DOCS = 800
TRAIN_LINES = 64
TRAIN_PARTS = 4
STEPS = 150
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Byte classes: 0 blank, 1 capital, 2 other letter (also every byte of a longer code point), 3 digit,
#: 4 symbol, 5 other.
_CLASS = np.full(256, 5, np.int64)
_CLASS[[32, 9, 10, 11, 12, 13]] = 0
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 1, 2, 2, 3
_CLASS[[ord(c) for c in SYMBOLS]] = 4
N_FEATURES = 9


class Counts(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


class Chain(NamedTuple):
    """Mean and spread of the features, weights for content, and the score of staying in a state."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    stay: float


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def repeated(ids: np.ndarray, window: int = 5) -> np.ndarray:
    """Which places lie in a window of words that is found twice or more; words are numbers."""
    marked = np.zeros(len(ids) + 1, np.int64)
    if len(ids) < window:
        return marked[:-1].astype(bool)
    codes = ids[:len(ids) - window + 1]
    for k in range(1, window):  # ranks stay below len(ids), so products are exact
        codes = _ranks(codes * len(ids) + ids[k:len(ids) - window + 1 + k])
    twice = np.flatnonzero(np.bincount(codes)[codes] > 1)
    np.add.at(marked, twice, 1)
    np.add.at(marked, twice + window, -1)
    return np.cumsum(marked[:-1]) > 0


def measure(text: str) -> tuple[Counts, np.ndarray, np.ndarray]:
    """The counts of a text, and the number of words and the features of each of its lines."""
    data = text.encode()
    lines = data.split(b"\n")
    line_words = [line.split() for line in lines]
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for ws in line_words for w in ws], np.int64)
    n_words = np.array([len(ws) for ws in line_words], np.int64)
    seen, again = set(), np.zeros(len(lines), bool)
    for i, line in enumerate(lines):
        if n_words[i]:
            again[i] = line in seen
            seen.add(line)
    places = repeated(ids)
    found = Counts(len(ids), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
                   int(again.sum()), int(places.sum()))

    of_line = np.repeat(np.arange(len(lines)), [len(line) + 1 for line in lines])[:len(data)]
    kinds = np.bincount(of_line * 6 + _CLASS[np.frombuffer(data, np.uint8)], minlength=6 * len(lines)).reshape(-1, 6)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    shown = np.maximum(kinds[:, 1:].sum(axis=1), 1)
    word_line = np.repeat(np.arange(len(lines)), n_words)
    in_window = np.bincount(word_line, places, minlength=len(lines))
    distinct = np.bincount(np.unique(word_line * (len(ids) + 1) + ids) // (len(ids) + 1), minlength=len(lines)) if len(ids) \
        else np.zeros(len(lines))
    some = np.maximum(n_words, 1)
    features = np.stack([
        np.log1p(n_words), kinds[:, 1] / letters, kinds[:, 3] / shown, kinds[:, 4] / shown, kinds[:, 5] / shown,
        shown / some / 10, distinct / some, in_window / some, again], axis=1)
    return found, n_words, features


def fails_base(found: Counts) -> bool:
    return found.n_words < 10 or 100 * found.n_repeat_words > 20 * found.n_words


def emissions(chain: Chain, features: np.ndarray) -> np.ndarray:
    """How much better content explains each line than boilerplate does."""
    scaled = (features - chain.mean) / chain.spread
    return np.clip(scaled, -5, 5) @ chain.weights[:-1] + chain.weights[-1]


def viterbi(scores: np.ndarray, stay: float) -> np.ndarray:
    """The best states (True: content), given each line's score for content and the score of staying."""
    # gap: how much better the best path into content is than the best one into boilerplate.
    gap, from_same_content, from_same_plain = 0.0, [], []
    for score in scores.tolist():
        # Entering content from content scores gap + stay against 0; boilerplate likewise.
        from_same_content.append(gap + stay >= 0)
        from_same_plain.append(stay > gap)
        gap = max(gap + stay, 0.0) - max(stay, gap) + score
    states, state = np.zeros(len(scores), bool), gap >= 0
    for i in range(len(scores) - 1, -1, -1):
        states[i] = state
        state = from_same_content[i] if state else not from_same_plain[i]
    return states


def fit(sequences: list[np.ndarray], labels: list[int]) -> Chain:
    """Raise the conditional likelihood by gradient steps over the whole sample, first line by line, then as a chain."""
    if not sequences or len(set(labels)) < 2:
        return Chain(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), 0.0)
    every = np.concatenate(sequences)
    mean, spread = every.mean(axis=0), every.std(axis=0) + 1e-3
    cut = [(s[i:i + TRAIN_LINES], y) for s, y in zip(sequences, labels) for i in range(0, len(s), TRAIN_LINES)]
    length = np.array([len(s) for s, _ in cut])
    x = np.zeros((len(cut), length.max(), N_FEATURES + 1))
    for i, (s, _) in enumerate(cut):
        x[i, :len(s), :-1] = np.clip((s - mean) / spread, -5, 5)
        x[i, :len(s), -1] = 1
    real = np.arange(x.shape[1]) < length[:, None]
    owner = np.array([i for i, seq in enumerate(sequences) for _ in range(0, len(seq), TRAIN_LINES)])
    gold = np.array([y for _, y in cut])[:, None] * real
    # Both kinds of documents count alike, however many there are of each.
    share = np.array([y for _, y in cut]).mean().clip(0.02, 0.98)
    cost = np.where(np.array([y for _, y in cut]) == 1, 0.5 / share, 0.5 / (1 - share)) / len(cut)
    apart, _ = climb(x, real, gold, cost, np.zeros(N_FEATURES + 1), learn_stay=False)
    weights, stay = climb(x, real, line_labels(x @ apart, gold, real, owner), cost, apart, learn_stay=True)
    return Chain(mean, spread, weights, stay)


def line_labels(scores: np.ndarray, gold: np.ndarray, real: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The labels of lines: their document's, but for lines that look like those of the other kind.

    Where that would be half of a document's lines or more, all keep its label, which the chain has to give back.
    """
    odd = ((scores > 0) != (gold > 0)) & real
    lines, odd_lines = np.bincount(owner, real.sum(axis=1)), np.bincount(owner, odd.sum(axis=1))
    few = (2 * odd_lines < lines)[owner]
    return np.where(odd & few[:, None], 1 - gold, gold) * real


def climb(
    x: np.ndarray, real: np.ndarray, gold: np.ndarray, cost: np.ndarray, weights: np.ndarray, learn_stay: bool,
) -> tuple[np.ndarray, float]:
    """Weights and the score of staying that raise the likelihood of the gold states, from ``weights`` on."""
    stay, squares = 0.0, np.zeros(N_FEATURES + 2)
    stays = ((gold[:, 1:] == gold[:, :-1]) & real[:, 1:]).sum(axis=1)
    for _ in range(STEPS):
        content, same = marginals(x @ weights, stay, real)
        slope = np.append(np.einsum("i,ij,ijk->k", cost, (gold - content) * real, x) - 1e-3 * weights,
                          (cost * (stays - same)).sum() - 1e-2 * stay if learn_stay else 0.0)
        squares += slope * slope
        move = 0.3 * slope / np.sqrt(squares + 1e-9)
        weights, stay = weights + move[:-1], stay + float(move[-1])
    return weights, stay


def marginals(scores: np.ndarray, stay: float, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each line, and the expected number of times that each sequence stays in its state."""
    rows, width = scores.shape
    moves = np.array([[stay, 0.0], [0.0, stay]])
    emit = np.stack([np.zeros_like(scores), scores], axis=2) * real[:, :, None]
    forward, backward = np.zeros((rows, width, 2)), np.zeros((rows, width, 2))
    forward[:, 0] = emit[:, 0]
    for t in range(1, width):
        step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
        forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
    for t in range(width - 2, -1, -1):
        step = np.logaddexp.reduce(moves[None] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(real[:, t + 1, None], step, 0.0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    content = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])
    after = emit[:, 1:] + backward[:, 1:]
    same = np.exp(forward[:, :-1] + stay + after - total[:, None, None]).sum(axis=2) * real[:, 1:]
    return content, same.sum(axis=1)


def some_lines(features: np.ndarray) -> np.ndarray:
    """All lines of a document, or of a long one TRAIN_PARTS runs that lie evenly in it."""
    if len(features) <= TRAIN_PARTS * TRAIN_LINES:
        return features
    starts = np.linspace(0, len(features) - TRAIN_LINES, TRAIN_PARTS).astype(int)
    return np.concatenate([features[s:s + TRAIN_LINES] for s in starts])


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", sample: int = TRAIN_DOCS,
) -> Chain:
    """A chain from at most ``sample`` labelled documents, the first ones in the order of a hash of the id.

    Only the features of TRAIN_PARTS runs of TRAIN_LINES lines of a sampled document come back to the driver at most.
    """
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    chosen = pick(labels, id_column, label_column).toDF("doc_id", "label").where(
        "doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("label").cast("long").alias("label"), F.min("text").alias("text"))

    def work(batches):
        for batch in batches:
            found = [some_lines(measure(t.as_py() or "")[2]).astype(np.float32).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "label", "features"])

    found = sorted(arrow_map(rows, work, "doc_id bigint, label bigint, features binary").collect())
    return fit([np.frombuffer(r.features, np.float32).reshape(-1, N_FEATURES).astype(float) for r in found[:sample]],
               [int(r.label > 0) for r in found[:sample]])


SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, content_share double")


def judge(chain: Chain, text: str, least_share: float) -> tuple:
    found, n_words, features = measure(text)
    content = viterbi(emissions(chain, features), chain.stay)
    share = float(n_words[content].sum() / found.n_words) if found.n_words else 0.0
    failed = fails_base(found)
    return (*found, failed, not failed and share >= least_share, share)


def judge_documents(
    docs: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text", least_share: float = 0.5,
) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and content_share for every row of ``docs``."""
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def work(batches):
        for batch in batches:
            rows = [judge(chain, t.as_py() or "", least_share) for t in batch.column(1)]
            columns = zip(*rows) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", *names])

    return arrow_map(docs, work, f"doc_id {docs.dtypes[0][1]}, {SCHEMA}")


def good_documents(docs: DataFrame, chain: Chain, text_column: str = "text", least_share: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; nothing is joined."""
    rows = numbered(docs)
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    text = docs.columns.index(text_column)

    def work(batches):
        for batch in batches:
            kept = [judge(chain, t.as_py() or "", least_share)[6] for t in batch.column(text)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return arrow_map(rows, work, schema).toDF(*docs.columns)
