"""Personal data: fixed patterns, and a character BiLSTM with a CRF on top that adds what they miss.

The network is trained in numpy on labelled spans, once: the shared folder keeps its arrays, by a digest of all that they
follow from, and later runs read them. A text is read in overlapping windows around every digit, every "@" and every "at"
or "dot" that stands alone. Each window is decoded; pieces of one kind that overlap are joined, and of spans that exclude
one another those of the largest total score are taken. Spans of the patterns stay. Beside them the network adds what
people write otherwise: addresses with blanks or words for their signs, numbers with other joints or no country code.

Offsets are code points, ends exclusive. Defined results: a null text counts as empty, without spans. Every row
gets a result, repeated rows too. Texts of any length are read whole, in linear time.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from hashlib import sha256
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fareflow.llm.common import arrow_map, by_bytes, pick
from fareflow.sources.tables import shared_folder

#: Fixed values, in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns; where another start in one run of characters can't do better, it isn't tried.
_EMAIL_END = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_START = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Where windows are read: at digits, "@", and the words by which people write an address for people.
_SEED = re.compile(r"[0-9@]|[\[({ ](?:at|dot)[\])} ]")

_AT_MARK, _DOT_WORD = re.compile(r"[\[(]at[\])]"), re.compile(r"[\[( ]dot[\]) ]")

WINDOW, STRIDE, REACH = 64, 32, 28
HIDDEN, EMBEDDED, LETTERS = 24, 12, 130
N_TAGS = len(KINDS) + 1
TRAIN_TEXTS, EPOCHS, BATCH = 4000, 8, 64
LEAST_SCORE = 0.25
STORED = "name string, shape array<int>, numbers array<float>"


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches: the run before an "@", from the end of the last match on, and the longest end."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        if at >= free and (end := _EMAIL_END.match(text, at + 1)):
            start = at
            while start > free and text[start - 1] in _EMAIL_START:
                start -= 1
            if start < at:
                found.append(Span(start, 0, end.end()))
                free = end.end()
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    found = emails(text) if "@" in text else []
    if _SEED.search(text):
        small = lambda part: len(part := part.lstrip("0")) < 4 and int(part or 0) <= 255
        found += [Span(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(m.start(), 2, m.end()))
        if "+" in text:
            found += [Span(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                      if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(found)


# ---- labelled spans

_SYLLABLES = "the an of er re lu mo ti sal ven kor da que ich un ó é ra le ne sto ba wi no pa".split()


def labelled_text(draw: random.Random) -> tuple[str, list[Span]]:
    """A line of prose with numbers of all sorts; the personal ones are labelled. Longer runs of digits than a card has
    are left to ``plausible``, which counts them."""
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    word = lambda: "".join(draw.choice(_SYLLABLES) for _ in range(draw.randrange(1, 4)))
    plain = lambda: re.sub("[^a-z]", "x", word())

    def card():
        first = draw.choice(["4", "5", "6", "34", "37", "36"])
        size = {"34": 15, "37": 15, "36": 14}.get(first, draw.choice([16, 16, 16, 13, 19]))
        first += digits(size - 1 - len(first))
        number = next(first + d for d in "0123456789" if luhn(first + d))
        joint = draw.choice(["", "", "", "", "", " ", " ", "-", "-", ".", "/", "  "])
        groups = (4, 6, 5) if size == 15 and draw.random() < 0.7 else (4,) * 5
        ends = [sum(groups[:k]) for k in range(len(groups) + 1)]
        return joint.join(filter(None, (number[x:y] for x, y in zip(ends, ends[1:]))))

    def phone():
        area, middle, last, country = digits(3), digits(3), digits(4), draw.choice(["1", "44", "49", "33", "7", "351", digits(2)])
        joint = draw.choice([" ", "-", ".", " ", "-"])
        return draw.choice([
            f"+{country} ({area}) {middle}-{last}", f"+{country}{joint}{area}{joint}{middle}{joint}{last}", f"+{country} {digits(2)} {digits(7)}",
            f"+{country}{area}{middle}{last}", f"({area}) {middle}{joint}{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}",
            f"+{country} {digits(3)} {digits(6)}", f"0{digits(3)}/{digits(7)}", f"00{country} {area} {middle} {last}", f"tel. {area} {middle} {last}"[5:]])

    def email():
        own = draw.choice([f"{plain()}.{digits(2)}", plain(), f"{plain()}_{plain()}", f"{plain()}.{plain()}", f"{plain()}{digits(draw.randrange(1, 4))}",
                           f"{plain()}+{plain()}", f"{plain()}-{plain()}"])
        names = [f"{plain()}{draw.choice(['', '', digits(1)])}", *draw.choice([["example", "com"], ["org"], ["net"], ["co", "uk"], ["com"], ["com"], ["example", "org"],
                                                                           ["edu", draw.choice("mx au br".split())], [draw.choice("de fr se ch it nl es eu io us".split())]])]
        if draw.random() < 0.3:
            names = [draw.choice(["mail", "example", "corp", "web"]) + draw.choice(["", digits(1)]), *names[1:]]
        sign, dot = draw.choice([("@", ".")] * 8 + [(" @ ", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", ".")])
        return (own if dot == "." else own.replace(".", dot)) + sign + dot.join(names)

    def address():
        part = lambda: str(draw.choice([draw.randrange(256), draw.randrange(100, 256), draw.choice([0, 1, 10, 127, 168, 192, 255])]))
        return draw.choice([".", ".", ".", ".", ".", ".", ".", " . ", "[.]", " dot "]).join(part() for _ in range(4))

    personal = (email, address, card, phone)
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    other = (
        lambda: str(draw.randrange(1900, 2040)), lambda: digits(draw.randrange(1, 7)), lambda: f"{digits(2)}.{digits(2)} %",
        lambda: f"{draw.randrange(1, 32)}.{draw.randrange(1, 13)}.{draw.randrange(1990, 2030)}", lambda: f"v{digits(1)}.{digits(1)}.{digits(2)}",
        lambda: f'{draw.choice(["token", "key", "secret"])} = "{hexes(draw.choice([32, 40]))}"', lambda: f"AKIA{hexes(16).upper()}",
        lambda: f"{digits(2)}:{digits(2)}:{digits(2)}", lambda: f"{digits(3)},{digits(3)},{digits(3)}", lambda: f"#{digits(8)}",
        lambda: f"({digits(4)}-{digits(4)})", lambda: f"{hexes(8)}-{hexes(4)}-{hexes(4)}", lambda: f"@{word()}", lambda: f"$ {digits(4)}.{digits(2)}",
        lambda: f"{word()} at {word()}", lambda: f"the {word()} dot {word()}", lambda: f"at {digits(1)} or {digits(2)}",
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)}", lambda: f"+{digits(2)} %", lambda: f"{digits(3)}.{digits(3)}", lambda: f"x={digits(2)}; y={digits(3)}",
        lambda: f"{word()}{digits(3)}", lambda: f"| {digits(2)} | {digits(3)} | {digits(2)} |")
    parts, spans, at = [], [], 0
    for _ in range(draw.randrange(4, 11)):
        roll = draw.random()
        kind = draw.randrange(len(KINDS)) if roll < 0.25 else None
        part = personal[kind]() if kind is not None else draw.choice(other)() if roll < 0.5 else word()
        if kind is not None and draw.random() < 0.3:  # what often stands before such data
            lead = draw.choice(["contact ", "mail: ", "call ", "phone ", "tel. ", "card ", "server ", "from ", "(", "<", "ip=", "IP ", "Email: "])
            parts.append(lead)
            at += len(lead)
        if kind is not None:
            spans.append(Span(at, kind, at + len(part)))
        part += draw.choice([" ", " ", " ", " ", ", ", ". ", "\n", ".\n", "; ", "! ", ") ", "### ", "&&& "])
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


# ---- network

def codes(text: str) -> np.ndarray:
    """ASCII characters stand for themselves in lower case, any digit for 0; other letters and other characters are one code each."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    high = np.array([128 if chr(p).isalpha() else 129 for p in points[points > 127]], np.int64)
    result = _CODES[np.minimum(points, 127)]
    result[points > 127] = high
    return result


_CODES = np.arange(128)
_CODES[65:91] += 32
_CODES[48:58] = 48


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Pass(NamedTuple):
    """What both directions of the LSTM have computed, place by place, for the way back."""

    letters: np.ndarray
    gates: list
    cells: list
    hidden: list


class Tagger:
    """Parameters and their use; ``params`` maps names to arrays. Those of the LSTM have one part a direction."""

    def __init__(self, seed: int = 7, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
        bias = np.zeros((2, 1, 4 * hidden), np.float32)
        bias[:, :, hidden:2 * hidden] = 1
        self.params = {"embed": scale(LETTERS, EMBEDDED) * 3, "in": scale(2, EMBEDDED, 4 * hidden), "own": scale(2, hidden, 4 * hidden),
                       "lstm_bias": bias, "out": scale(2 * hidden, N_TAGS), "bias": np.zeros(N_TAGS, np.float32),
                       "moves": np.zeros((N_TAGS, N_TAGS), np.float32)}

    def _run(self, letters: np.ndarray) -> Pass:
        p = self.params
        both = np.stack([letters, letters[:, ::-1]])
        table = p["embed"] @ p["in"] + p["lstm_bias"]
        size = p["own"].shape[1]
        cell = hidden = np.zeros((2, len(letters), size), table.dtype)
        done, ways = Pass(both, [], [], []), np.arange(2)[:, None]
        for t in range(letters.shape[1]):
            gate = table[ways, both[:, :, t]] + hidden @ p["own"]
            gate[:, :, :3 * size] = _sigmoid(gate[:, :, :3 * size])
            np.tanh(gate[:, :, 3 * size:], out=gate[:, :, 3 * size:])
            i, f, o, g = np.split(gate, 4, axis=2)
            cell = f * cell + i * g
            hidden = o * np.tanh(cell)
            done.gates.append(gate)
            done.cells.append(cell)
            done.hidden.append(hidden)
        return done

    def emissions(self, letters: np.ndarray):
        done = self._run(letters)
        states = np.stack(done.hidden, axis=2)
        both = np.concatenate([states[0], states[1][:, ::-1]], axis=2)
        return both @ self.params["out"] + self.params["bias"], both, done

    def slopes(self, letters: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean loss of a batch and its derivatives."""
        emit, both, done = self.emissions(letters)
        loss, d_emit, d_moves = crf_loss(emit, self.params["moves"], tags)
        out = {"moves": d_moves, "out": np.einsum("btd,btk->dk", both, d_emit), "bias": d_emit.sum(axis=(0, 1))}
        d_both, size = d_emit @ self.params["out"].T, self.params["own"].shape[1]
        return loss, out | self._back(done, np.stack([d_both[:, :, :size], d_both[:, ::-1, size:]]))

    def _back(self, done: Pass, d_hidden: np.ndarray) -> dict:
        p, rows = self.params, d_hidden.shape[1]
        own = np.zeros_like(p["own"])
        every = np.empty((d_hidden.shape[2], 2, rows, own.shape[2]), own.dtype)
        d_h = d_c = np.zeros((2, rows, own.shape[1]), own.dtype)
        back = p["own"].transpose(0, 2, 1)
        for t in range(d_hidden.shape[2] - 1, -1, -1):
            i, f, o, g = np.split(done.gates[t], 4, axis=2)
            before = done.cells[t - 1] if t else np.zeros_like(d_c)
            curved = np.tanh(done.cells[t])
            d_h = d_h + d_hidden[:, :, t]
            d_c = d_c + d_h * o * (1 - curved ** 2)
            z = np.concatenate([d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * curved * o * (1 - o), d_c * i * (1 - g ** 2)], axis=2)
            if t:
                own += done.hidden[t - 1].transpose(0, 2, 1) @ z
            every[t] = z
            d_h, d_c = z @ back, d_c * f
        # The slopes of a letter's table row are summed over all places that have the letter.
        places = (done.letters.transpose(2, 0, 1) + np.array([0, LETTERS])[:, None]).reshape(-1)
        order = np.argsort(places, kind="stable")
        seen, starts = np.unique(places[order], return_index=True)
        d_table = np.zeros((2 * LETTERS, own.shape[2]), own.dtype)
        d_table[seen] = np.add.reduceat(every.reshape(len(places), -1)[order], starts)
        d_table = d_table.reshape(2, LETTERS, -1)
        return {"own": own, "in": p["embed"].T @ d_table, "lstm_bias": d_table.sum(axis=1, keepdims=True),
                "embed": (d_table @ p["in"].transpose(0, 2, 1)).sum(axis=0)}

    def decode(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window, and how much better they are than tag 0, character by character."""
        emit = self.emissions(letters)[0]
        moves, (rows, width, _) = self.params["moves"], emit.shape
        best, came = emit[:, 0], np.zeros((rows, width, N_TAGS), np.int8)
        for t in range(1, width):
            ways = best[:, :, None] + moves
            came[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + emit[:, t]
        tags = np.zeros((rows, width), np.int64)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = came[np.arange(rows), t, tags[:, t]]
        return tags, np.take_along_axis(emit, tags[:, :, None], 2)[:, :, 0] - emit[:, :, 0]


def crf_loss(emit: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of the tags, and its derivatives by emissions and moves."""
    rows, width, _ = emit.shape
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    add = lambda x, axis: (top := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis=axis))
    ahead[:, 0] = emit[:, 0]
    for t in range(1, width):
        ahead[:, t] = add(ahead[:, t - 1, :, None] + moves, 1) + emit[:, t]
    for t in range(width - 2, -1, -1):
        back[:, t] = add(moves[None] + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    total = add(ahead[:, -1], 1)
    each = np.arange(rows)[:, None], np.arange(width)
    gold = emit[each[0], each[1], tags].sum(axis=1) + moves[tags[:, :-1], tags[:, 1:]].sum(axis=1)
    d_emit = np.exp(ahead + back - total[:, None, None])
    pairs = np.exp(ahead[:, :-1, :, None] + moves + (emit[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None])
    d_moves = pairs.sum(axis=(0, 1))
    np.add.at(d_moves, (tags[:, :-1], tags[:, 1:]), -1)
    d_emit[each[0], each[1], tags] -= 1
    return float((total - gold).mean()), d_emit / rows, d_moves / rows


def windows_of(length: int, marks: np.ndarray) -> list[int]:
    """The starts of the windows that cover all places within REACH of a mark, STRIDE apart."""
    starts, covered = [], -1
    for mark in marks.tolist():
        while covered < min(length, mark + REACH + 1):
            start = max(mark - REACH, covered - (WINDOW - STRIDE)) if covered >= 0 else mark - REACH
            start = max(0, start)
            starts.append(start)
            covered = start + WINDOW
    return starts


def cut(text_codes: np.ndarray, starts: list[int]) -> np.ndarray:
    """The windows' codes; 0 stands behind the end of the text."""
    padded = np.concatenate([text_codes, np.zeros(WINDOW, np.int64)])
    return padded[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)]


def train(texts: int = TRAIN_TEXTS, epochs: int = EPOCHS, seed: int = 1) -> Tagger:
    """A tagger from ``texts`` labelled texts, by Adam steps over shuffled batches; the same on each call."""
    draw, tagger = random.Random(seed), Tagger()
    letters, tags = [], []
    for _ in range(texts):
        text, spans = labelled_text(draw)
        own = np.zeros(len(text) + WINDOW, np.int64)
        for span in spans:
            own[span.start:span.end] = span.kind + 1
        starts = list(range(0, max(1, len(text) - STRIDE), STRIDE))
        letters.append(cut(codes(text), starts))
        tags.append(own[np.array(starts)[:, None] + np.arange(WINDOW)])
    letters, tags = np.concatenate(letters), np.concatenate(tags)
    rng, step = np.random.default_rng(seed), 0
    first = {k: np.zeros_like(v) for k, v in tagger.params.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.params.items()}
    for epoch in range(epochs):
        order = rng.permutation(len(letters))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            _, slopes = tagger.slopes(letters[some], tags[some])
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for name, slope in slopes.items():
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.001 * (slope * slope - second[name])
                tagger.params[name] = (tagger.params[name] - rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return tagger


@lru_cache(maxsize=1)
def _trained() -> Tagger:
    return train()


def recipe() -> str:
    """A digest of what the trained arrays follow from: the code and constants of this module."""
    return sha256(Path(__file__).read_bytes()).hexdigest()[:16]


def trained_tagger(spark: SparkSession) -> Tagger:
    """The network of this module's training rows: read from the shared folder, or trained and kept there."""
    path = f"{shared_folder(spark)}/fareflow-models/tagger-{recipe()}"
    tagger = Tagger()
    try:
        kept = {r.name: np.array(r.numbers, np.float32).reshape(r.shape) for r in spark.read.schema(STORED).parquet(path).collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = {}
    if kept.keys() != tagger.params.keys():
        kept = _trained().params
        spark.createDataFrame([(n, list(v.shape), v.reshape(-1).tolist()) for n, v in kept.items()], STORED).coalesce(1).write.mode(
            "overwrite").parquet(path)
    tagger.params = kept
    return tagger


# ---- spans

def plausible(kind: int, text: str) -> bool:
    """Whether the characters that a kind can't do without are there."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    if kind == 0:
        spelled = _DOT_WORD.search(text) is not None
        return ("." in text or spelled) if "@" in text or _AT_MARK.search(text) else spelled and " at " in text
    return (len(digits) >= 4 and max(text.count("."), text.count("dot")) == 3, 12 <= len(digits) <= 19 and luhn(digits),
            9 <= len(digits) <= 15)[kind - 1]


def reconcile(pieces: list[tuple[int, int, int, float]]) -> list[tuple[Span, float]]:
    """Pieces (kind, start, end, score) of one text: join those of a kind that overlap, then take the
    spans that exclude one another by their largest total score."""
    joined: list[list] = []
    for kind, start, end, score in sorted(pieces):
        if joined and joined[-1][0] == kind and start < joined[-1][2]:
            joined[-1][2], joined[-1][3] = max(end, joined[-1][2]), max(score, joined[-1][3])
        else:
            joined.append([kind, start, end, score])
    joined.sort(key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in joined]
    best, taken = [0.0], []
    for kind, start, end, score in joined:
        before = int(np.searchsorted(ends[:len(taken)], start, "right"))
        taken.append(before if score + best[before] > best[-1] else -1)
        best.append(max(score + best[before], best[-1]))
    chosen, at = [], len(joined)
    while at > 0:
        if taken[at - 1] < 0:
            at -= 1
        else:
            kind, start, end, score = joined[at - 1]
            chosen.append((Span(start, kind, end), score))
            at = taken[at - 1]
    return chosen[::-1]


def network_spans(tagger: Tagger, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """The spans of each text that the network adds to its base spans."""
    owner, places, parts = [], [], []
    for i, text in enumerate(texts):
        marks = np.array([m.start() for m in _SEED.finditer(text)], np.int64)
        if len(marks):
            starts = windows_of(len(text), marks)
            parts.append(cut(codes(text), starts))
            owner += [i] * len(starts)
            places += starts
    pieces: list[list] = [[] for _ in texts]
    letters = np.concatenate(parts) if parts else np.zeros((0, WINDOW), np.int64)
    for at in range(0, len(letters), 1024):
        tags, gains = tagger.decode(letters[at:at + 1024])
        bounded = np.pad(tags, ((0, 0), (1, 1)))
        rows, columns = np.nonzero(np.diff(bounded, axis=1))
        for row, column in zip(rows.tolist(), columns.tolist()):
            tag = int(bounded[row, column + 1])
            if tag:
                end = column + int(np.argmax(bounded[row, column + 1:] != tag))
                start = places[at + row] + column
                pieces[owner[at + row]].append((tag - 1, start, start + end - column, float(gains[row, column:end].sum())))
    return [beside(text, reconcile(found), base) for text, found, base in zip(texts, pieces, bases)]


def beside(text: str, found: list[tuple[Span, float]], base: list[Span]) -> list[Span]:
    """The sure and plausible ones of the spans, without blanks at their ends, that touch no base span.

    An address whose "@" has no blank beside it ends at the blanks around.
    """
    starts = [s.start for s in base]
    ends = np.maximum.accumulate([0, *(s.end for s in base)])
    kept = []
    for span, score in found:
        raw = text[span.start:span.end]
        start, end = span.start + len(raw) - len(raw.lstrip()), span.end - len(raw) + len(raw.rstrip())
        at = text.find("@", start, end) if span.kind == 0 else -1
        if start < at < end - 1 and not (text[at - 1].isspace() or text[at + 1].isspace()):
            start = max([start, *(m.end() + start for m in re.finditer(r"\s", text[start:at]))])
            end = min([end, *(m.start() + at for m in re.finditer(r"\s", text[at:end]))])
        free = ends[np.searchsorted(starts, end, "left")] <= start
        if free and score >= LEAST_SCORE * (end - start) and plausible(span.kind, text[start:end]):
            kept.append(Span(start, span.kind, end))
    return kept


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def find_personal_data(
    docs: DataFrame, tagger: Tagger, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_spans and spans (kind:start:end, comma-joined)."""
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")

    def work(batches):
        for batch in batches:
            for part in by_bytes(batch, 1, 1 << 20):
                texts = [t.as_py() or "" for t in part.column(1)]
                bases = [base_spans(t) for t in texts]
                added = network_spans(tagger, texts, bases)
                counts = [[sum(s.kind == k for s in base) for base in bases] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(map(written, bases), pa.string()),
                     pa.array([written([*b, *a]) for b, a in zip(bases, added)], pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    columns = ", ".join(f"n_{k} bigint" for k in KINDS)
    return arrow_map(docs, work, f"doc_id {docs.dtypes[0][1]}, {columns}, base_spans string, spans string")
