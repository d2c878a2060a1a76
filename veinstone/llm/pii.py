"""Personal data by fixed patterns and a linear-chain CRF.

The patterns find e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers with a
leading plus. The CRF adds what is written otherwise (bracketed "at" and "dot", phone numbers
without a plus, card numbers with dots): its tokens are runs of letters and digits and single
other characters, its features word shapes and a few words at offsets -2 to 2, its labels
begin/inside of each kind and outside. It is trained by stochastic gradient on `labelled_rows()`,
a small table made by rule, and decoded by Viterbi for all candidate stretches of an Arrow chunk
at once. Stretches are what lies within REACH characters, on the same line, of a digit, an at
sign or a written-out "dot" or bracketed "at", and on to the ends of what is not blank there, so
that no address or number is cut: elsewhere every label is outside. A decoded span counts if it
passes the check of its kind and touches no span of the patterns.

Texts are read whole; offsets are code points, ends exclusive. All searches are linear in the
text, whatever it holds, and Viterbi keeps one byte a token and label. The model is a few hundred
KB and broadcast.

Defined results: a null text is an empty one without spans; overlapping spans of different kinds
are all reported and redacted as one stretch named by the first; equal starts cannot occur within
a kind; repeated rows are scanned each on their own; an empty table gives an empty result; only
key and text are read by `find`; `redact` carries all other columns through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import chunks, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Characters around a trigger that the CRF reads at least.
REACH = 48

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TRIGGER = re.compile(r"[0-9@]+|(?i:[\[({<] ?(?:at|dot) ?[\])}>])|(?i:\bdot\b)")
TOKEN = re.compile(r"[^\W_]+|[^\s]")
FILLED = re.compile(r"\S*")
DIGITS = str.maketrans("", "", "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isdigit()) + " ")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def ascii_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            floor = m.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
        for m in CARD.finditer(text):
            if 13 <= len(m[0]) <= 40 and 13 <= len(d := ascii_digits(m[0])) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(ascii_digits(m[0])) <= 15]
    return out


# --- the CRF ---------------------------------------------------------------------------------

#: Words that are features of their own.
WORDS = frozenset("at dot com org net edu tel phone call mobile fax cell mail email e contact reach card visa ip host server version password token key price total id".split())


def shape(token: str) -> str:
    """A token's word, if it is one of WORDS, and its shape: runs of capitals, letters and digits, with the digits' number."""
    low = token.lower()
    if low in WORDS:
        return "w:" + low
    if token.isdigit() and token.isascii():
        return f"d{min(len(token), 20)}"
    if len(token) == 1 and not token.isalnum():
        return token
    out, last = [], ""
    for c in token:
        kind = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else "?"
        if kind != last:
            out.append(kind)
        elif not out[-1].endswith("+"):
            out[-1] += "+"
        last = kind
    return "".join(out)


def tokens_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Each token's shape, with whether a blank stands before it, and its place."""
    shapes, places, last = [], [], 0
    for m in TOKEN.finditer(text):
        shapes.append(shape(m[0]) + ("_" if m.start() > last or not places else ""))
        places.append(m.span())
        last = m.end()
    return shapes, places


OFFSETS = (-2, -1, 0, 1, 2)


@dataclass
class Model:
    """emit[offset][shape id] and moves are scores by label; shape 0 is unknown, 1 lies beyond either end."""

    shapes: dict[str, int]
    emit: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Emission scores of sequences of shape ids, one row a sequence, 1 beyond its end."""
        return self._scores(np.pad(ids, ((0, 0), (2, 2)), constant_values=1), 0, ids.shape[1])

    def _scores(self, wide: np.ndarray, a: int, b: int) -> np.ndarray:
        """Those of places a to b of sequences with two more places at either side."""
        return sum(self.emit[k][wide[:, k + a : k + b]] for k in range(len(OFFSETS)))

    def decode(self, sequences: list[list[str]], cells: int = 1 << 18) -> list[np.ndarray]:
        """The best labels of each sequence of shapes, by Viterbi over batches of sequences of like length."""
        out: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(sequences[order[stop]]) <= cells and len(sequences[order[stop]]) <= 2 * len(sequences[order[at]]) + 8:
                stop += 1
            some = order[at:stop]
            sizes = np.array([len(sequences[i]) for i in some])
            ids = np.ones((len(some), max(1, sizes.max())), np.int32)
            for r, i in enumerate(some):
                ids[r, : sizes[r]] = [self.shapes.get(s, 0) for s in sequences[i]]
            wide = np.pad(ids, ((0, 0), (2, 2)), constant_values=1)
            back = np.zeros(ids.shape + (len(LABELS),), np.int8)
            step = max(1, cells // len(some))
            for t in range(ids.shape[1]):
                if t % step == 0:
                    scores = self._scores(wide, t, min(t + step, ids.shape[1]))
                if t == 0:
                    best = scores[:, 0] + self.first
                    final = best.copy()
                    continue
                paths = best[:, :, None] + self.moves
                back[:, t] = paths.argmax(1)
                best = paths.max(1) + scores[:, t % step]
                final[sizes == t + 1] = best[sizes == t + 1]
            label = final.argmax(1)
            labels = np.zeros(ids.shape, np.int8)
            rows = np.arange(len(some))
            for t in range(ids.shape[1] - 1, -1, -1):
                labels[:, t] = label
                label = np.where(t < sizes, back[rows, t, label], label)
            for r, i in enumerate(some):
                out[i] = labels[r, : sizes[r]]
            at = stop
        return out


def labelled_rows(n: int = 400, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The training table: (text, spans), made by rule; spans are (kind, start, end)."""
    r = np.random.Generator(np.random.PCG64(seed))
    pick = lambda *x: x[r.integers(len(x))]
    digits = lambda k: "".join(str(d) for d in r.integers(0, 10, k))
    syllables = "an the er on re ti sh ed in le ou que tion mar ben sol dor kin lu va zo ment".split()
    word = lambda: "".join(pick(*syllables) for _ in range(r.integers(1, 4)))
    prose = lambda: " ".join(word() for _ in range(r.integers(1, 6)))

    def card(sep: str) -> str:
        d = "4" + digits(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def email() -> str:
        at, dot = pick((" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "[dot]"), ("(at)", "."), (" [at] ", "."), (" AT ", " DOT "))
        name = word() + pick("", "." + word(), digits(2), "." + digits(2), "_" + word())
        return name + at + word() + pick("", digits(1)) + dot + pick("com", "org", "net", "example" + dot + "com")

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"({a}) {b} {c}", f"001 {a} {b} {c}", f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b} {c}")

    def address() -> str:
        return ".".join(str(x) for x in r.integers(1, 256, 4))

    def nothing() -> str:
        return pick(
            lambda: f"{pick('19', '20')}{digits(2)}-{digits(2)}-{digits(2)}", lambda: f"password={r.bytes(9).hex()}", lambda: f'token = "{r.bytes(20).hex()}"', lambda: "AKIA" + digits(3) + "QW7" + digits(4) + "ZT",
            lambda: f"version {digits(1)}.{digits(1)}.{digits(2)}", lambda: f"{digits(2)},{digits(3)}.{digits(2)}", lambda: digits(int(r.integers(1, 12))), lambda: f"{digits(2)}:{digits(2)}", lambda: f"{digits(2)}%", lambda: f"GNU GPL, version {digits(1)}",
            lambda: f"CC BY-NC {digits(1)}.0", lambda: f"{word()} at {word()}", lambda: f"a dot on the {word()}", lambda: f"{digits(3)} {digits(3)}", lambda: f"pages {digits(2)}-{digits(3)}", lambda: f"@{word()}", lambda: f"{digits(1)} + {digits(1)}", lambda: f"({digits(4)})",
        )()

    makers = {"email": email, "phone": phone, "ip": address, "card": lambda: card(pick(".", " ", "-", "", "/"))}
    rows = []
    for _ in range(n):
        text, spans = prose(), []
        for _ in range(r.integers(1, 4)):
            kind = pick("email", "phone", "ip", "card", "", "", "")
            item = makers[kind]() if kind else nothing()
            text += pick(" ", ", ", ": ", ". ")
            if kind:
                spans.append((kind, len(text), len(text) + len(item)))
            text += item + pick("", ".", ",") + " " + prose()
        rows.append((text, spans))
    return rows


def train(rows: list[tuple[str, list[tuple[str, int, int]]]] | None = None, epochs: int = 10, rate: float = 0.25, penalty: float = 1e-4, seed: int = 3) -> Model:
    """A model fitted by AdaGrad on the conditional likelihood, the same on every run."""
    rows = labelled_rows() if rows is None else rows
    parsed, shapes = [], {"": 0, "|": 1}
    for text, spans in rows:
        own, places = tokens_of(text)
        labels = np.zeros(len(own), np.int64)
        for kind, a, b in spans:
            inside = [i for i, (s, e) in enumerate(places) if s >= a and e <= b]
            for j, i in enumerate(inside):
                labels[i] = LABELS.index(("I-" if j else "B-") + kind)
        ids = np.array([shapes.setdefault(s, len(shapes)) for s in own], np.int32)
        if len(ids):
            parsed.append((ids, labels))
    k, o = len(LABELS), len(OFFSETS)
    model = Model(shapes, np.zeros((o, len(shapes), k)), np.zeros((k, k)), np.zeros(k))
    squares = [np.full_like(x, 1e-6) for x in (model.emit, model.moves, model.first)]
    order = np.random.Generator(np.random.PCG64(seed))
    logsum = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    for _ in range(epochs):
        for i in order.permutation(len(parsed)):
            ids, labels = parsed[i]
            t = len(ids)
            scores = model.scores(ids[None])[0]
            ahead, behind = np.empty((t, k)), np.zeros((t, k))
            ahead[0] = scores[0] + model.first
            for j in range(1, t):
                ahead[j] = logsum(ahead[j - 1][:, None] + model.moves, 0) + scores[j]
            for j in range(t - 2, -1, -1):
                behind[j] = logsum(model.moves + (scores[j + 1] + behind[j + 1])[None], 1)
            total = logsum(ahead[-1], 0)
            slope = -np.exp(ahead + behind - total)  # observed less expected
            slope[np.arange(t), labels] += 1
            moves = np.zeros((k, k))
            if t > 1:
                pairs = ahead[:-1, :, None] + model.moves + (scores[1:] + behind[1:])[:, None, :] - total
                moves -= np.exp(pairs).sum(0)
                np.add.at(moves, (labels[:-1], labels[1:]), 1)
            wide = np.pad(ids, 2, constant_values=1)
            for f in range(o):
                some, back = np.unique(wide[f : f + t], return_inverse=True)
                g = np.zeros((len(some), k))
                np.add.at(g, back, slope)
                g -= penalty * model.emit[f][some]
                squares[0][f][some] += g * g
                model.emit[f][some] += rate * g / np.sqrt(squares[0][f][some])
            for w, g, s in ((model.moves, moves, squares[1]), (model.first, slope[0], squares[2])):
                g = g - penalty * w
                s += g * g
                w += rate * g / np.sqrt(s)
    return model


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text that the CRF reads."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        last = out[-1][1] if out else 0  # what lies before was seen for the stretch before
        if m.end() + REACH <= last:
            continue
        a, b = max(last, m.start() - REACH), min(len(text), m.end() + REACH)
        a = max(a, text.rfind("\n", a, m.start()) + 1)
        while a > last and not text[a - 1].isspace():
            a -= 1
        if (e := text.find("\n", m.end(), b)) >= 0:
            b = e
        else:
            b = FILLED.match(text, b).end()
        if out and a <= last:
            out[-1][1] = max(b, last)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def plausible(kind: int, s: str) -> bool:
    """Whether a decoded span may be of its kind."""
    digits = ascii_digits(s)
    if kind == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s*(?:@|[\[({<]\s*(?i:at)\s*[\])}>]|\s(?i:at)\s)\s*[A-Za-z0-9-]+(?:\s*(?:\.|[\[({<]\s*(?i:dot)\s*[\])}>]|\s(?i:dot)\s)\s*[A-Za-z0-9-]+)+", s)) and bool(re.search(r"(?i)dot|[\[({<@]", s))
    if kind == 1:
        parts = re.split(r"\D+", s)
        return len(parts) == 4 and all(0 < len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[A-Za-z]", s)
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", s) and bool(re.search(r"[ ().-]", s))


def spans_of(texts: list[str], model: Model) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text the patterns' spans and all spans, each (kind, start, end) by kind and start."""
    base = [patterns(t) for t in texts]
    where, sequences, places = [], [], []
    for i, t in enumerate(texts):
        for a, b in stretches(t):
            own, at = tokens_of(t[a:b])
            if own:
                where.append((i, a))
                sequences.append(own)
                places.append(at)
    added: dict[int, list[tuple[int, int, int]]] = {}
    for (i, a), labels, at in zip(where, model.decode(sequences), places):
        j = 0
        while j < len(labels):
            if labels[j] % 2 == 0:  # outside, or an inside without a beginning
                j += 1
                continue
            end = j + 1
            while end < len(labels) and labels[end] == labels[j] + 1:
                end += 1
            kind, start, stop = int(labels[j]) // 2, a + at[j][0], a + at[end - 1][1]
            if plausible(kind, texts[i][start:stop]) and not any(start < e and s < stop for _, s, e in base[i]):
                added.setdefault(i, []).append((kind, start, stop))
            j = end
    return [(b, sorted(b + added[i]) if i in added else b) for i, b in enumerate(base)]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of touching or overlapping spans replaced by <KIND> of the first."""
    out, last = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if a >= last:
            out += [text[last:a], f"<{KINDS[k].upper()}>"]
        last = max(last, b)
    return "".join(out) + text[last:]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone and base_sha256 of the patterns' spans, and spans, all of them."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, "_text"):
            found = spans_of(texts_of(rows, "_text").to_pylist(), shared.value)
            columns = {"key": rows.column("_key").combine_chunks()}
            for k, name in enumerate(KINDS):
                columns[f"n_{name}"] = pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string())
            columns["spans"] = pa.array([listed(every) for _, every in found], pa.string())
            yield pa.record_batch(columns)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, f"key {kind}, {counts}, base_sha256 string, spans string").withColumnRenamed("key", key)


def redact(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """docs with the personal data of text replaced; null stays null, all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, text):
            texts = rows.column(text).to_pylist()
            found = spans_of([t or "" for t in texts], shared.value)
            clean = pa.array([t if t is None or not every else redacted(t, every) for t, (_, every) in zip(texts, found)], pa.string())
            yield from rows.set_column(rows.schema.get_field_index(text), text, clean).to_batches()

    return docs.mapInArrow(run, docs.schema)
