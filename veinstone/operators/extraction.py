"""Values, entities, events and table cells out of text, with offsets: Arrow-batched Python, one pass a document.

Patterns are compiled once a task from a small specification: variables with aliases, unit and
bounds, and entities with aliases. Engines are functions of (text, reader) that yield findings;
the registry is open. Texts are read whole; a finding's snippet holds up to SNIPPET characters, as
many as its point id is made of at most ID_SNIPPET.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.functions.science import plain_change
from veinstone.functions.text import LOOKALIKES, SCANNED_CELSIUS
from veinstone.operators.topics import merged_aliases

#: Confidences of the engines' findings, and lengths of snippets.
CONFIDENCE = {"text": 0.77, "table": 0.88, "figure": 0.76}
SNIPPET, ID_SNIPPET = 1200, 120
#: Spellings of units that count as given, by unit.
GIVEN_UNITS = {"nm": ("nm", "nanometer", "nanometers"), "c": ("c", "oc", "°c", "degc", "celsius", "°с", "с"), "k": ("k", "kelvin", "к")}
CELSIUS = r"(?:°\s*[ck]|o\s*c|oc|degc|celsius|kelvin|\b[ck]\b)"
LENGTHS = r"nm|nanometer|nanometers|um|μm|micrometer|mm"
#: Signs of a unit near a number without one, by what the variable's name holds.
HINTS = {"temperature": re.compile(rf"(?:{CELSIUS}|\b[ck]\b)", re.I), "thickness": re.compile(rf"\b(?:{LENGTHS})\b", re.I)}
#: Characters before and after a number in which a unit, or a sign of an identifier, counts.
HINT_BEFORE, HINT_AFTER, NOISE_AROUND = 14, 20, 36
NOISE = re.compile(r"\b(?:doi|issn|isbn|pmid|pmcid|arxiv|vol(?:ume)?|issue|pp\.?|pages?)\b", re.I)
NUMBER = r"(?<![0-9])-?\d+(?:\.\d+)?"
RANGE = r"\s*(?:[-–~to]{1,4}\s*(?P<b>-?\d+(?:\.\d+)?))?\s*"
#: Phrases of the pair and event patterns.
PHASES = r"ni\s*si\s*2|nisi2|ni\s*2\s*si|ni2si|ni\s*si|nisi"
FORMS = r"forms?|appears?|transforms?"
FOR_AT = re.compile(rf"for\s+(?P<x>-?\d+(?:\.\d+)?)\s*(?P<xu>nm|nanometer|nanometers)?[^.]{{0,180}}?(?:at|around|near|~)\s*(?P<y>-?\d+(?:\.\d+)?)\s*(?P<yu>{CELSIUS})", re.I)
PHASE_AT = re.compile(rf"(?P<entity>ni2si|nisi2|nisi)[^.]{{0,120}}?(?:{FORMS}|formation|formed)[^.]{{0,120}}?(?P<y>-?\d+(?:\.\d+)?)\s*(?P<yu>{CELSIUS})", re.I)
THICK = [
    re.compile(rf"(?:thickness|initial\s+ni\s+film(?:s)?|film(?:s)?\s+thickness|ni\s+film(?:s)?\s+of|as-deposited\s+ni\s+film(?:s)?)[^.]{{0,40}}?(?P<a>-?\d+(?:\.\d+)?){RANGE}(?P<u>{LENGTHS})", re.I),
    re.compile(rf"(?P<a>-?\d+(?:\.\d+)?){RANGE}(?P<u>{LENGTHS})\s*(?:ni|nickel)?\s*(?:film|layer)s?", re.I),
]
ENTITY_AT = re.compile(rf"(?P<entity>{PHASES})\b[^.]{{0,120}}?(?:at|around|near|between|from|to|up\s*to|temperature(?:s)?(?:\s*range)?(?:\s*of)?)\s*(?P<a>-?\d+(?:\.\d+)?){RANGE}(?P<u>{CELSIUS})", re.I)
AT_ENTITY = re.compile(rf"(?P<a>-?\d+(?:\.\d+)?){RANGE}(?P<u>{CELSIUS})[^.]{{0,100}}?(?P<entity>{PHASES})\b[^.]{{0,60}}?(?:{FORMS}|phase|formation)", re.I)
ANY_TEMPERATURE = re.compile(rf"(?P<a>-?\d+(?:\.\d+)?)\s*(?:[-–~]|to)?\s*(?P<b>-?\d+(?:\.\d+)?)?\s*(?P<u>{CELSIUS})", re.I)
EVENT_WORDS = re.compile(r"\b(?:anneal|annealing|temperature|phase|form|transform|silicide)\b")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Variable:
    name: str
    aliases: tuple[str, ...] = ()
    unit: str = ""
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Spec:
    """x and y: names of the primary variables, the first two if not given."""

    variables: tuple[Variable, ...]
    entities: dict[str, tuple[str, ...]] = field(default_factory=dict)
    overrides: dict[str, str] = field(default_factory=dict)
    radius: int = 1
    x: str = ""
    y: str = ""
    cues: tuple[str, ...] = ("fig", "figure", "caption")

    def __post_init__(self):
        if not self.variables:
            raise ValueError("a specification needs a variable")
        for v in self.variables:
            if v.low is not None and v.high is not None and v.high < v.low:
                raise ValueError(f"{v.name}: the upper bound is below the lower one")


@dataclass(frozen=True)
class Finding:
    variable: str
    value: float
    unit: str
    entity: str
    engine: str
    locator: str
    snippet: str
    confidence: float


@dataclass(frozen=True)
class Event:
    entity: str
    x: float
    y: float
    confidence: float


def plain(text: str) -> str:
    """The text with look-alike characters and scanned degree marks replaced."""
    text = text.translate(LOOKALIKES)
    for pattern in SCANNED_CELSIUS:
        text = re.sub(pattern, " c ", text, flags=re.I)
    return text


def flexible(alias: str) -> re.Pattern:
    """An alias that may have more blanks, none for a hyphen, and blanks between letters and digits; not within a word."""
    low, parts, last = alias.strip().lower(), [], ""
    for c in low:
        kind = "d" if c.isdigit() else "a" if c.isalpha() else ""
        if c.isspace() or c == "-":
            parts.append(r"\s+" if c.isspace() else r"[-\s]?")
            last = ""
            continue
        parts.append((r"\s*" if last and kind and last != kind else "") + re.escape(c))
        last = kind
    body = "".join(parts)
    return re.compile(rf"(?<![a-z0-9]){body}(?![a-z0-9])" if re.match(r"^[a-z0-9].*[a-z0-9]$", low) else body, re.I)


def unsigned(text: str, token: str) -> str:
    """A number without the dash that makes it the end of a range."""
    return token[1:] if token.startswith("-") and re.search(r"\d\s*-\s*" + re.escape(token[1:]), text) else token


def noisy(text: str, start: int, end: int, token: str) -> bool:
    """Part of an identifier: a keyword near it, or a long number in a range of such or beside a slash or colon."""
    around = text[max(0, start - NOISE_AROUND) : end + NOISE_AROUND]
    if NOISE.search(around):
        return True
    digits = re.sub("[^0-9]", "", token)
    if len(digits) < 4:
        return False
    beside = text[max(0, start - 1) : start], text[end : end + 1]
    return bool(re.search(rf"\d{{4,}}\s*-\s*{digits}|{digits}\s*-\s*\d{{3,}}", around)) or any(c in ("/", ":") for c in beside)


class Reader:
    """A specification's compiled patterns."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.by_name = {v.name: v for v in spec.variables}
        names = [v.name for v in spec.variables]
        self.x, self.y = self.by_name.get(spec.x or names[0]), self.by_name.get(spec.y or (names[1] if len(names) > 1 else ""))
        self.aliases = [(v, [re.compile(p, re.I) for a in (v.name, *v.aliases) for p in (rf"{re.escape(a)}\s*[:=]?\s*({NUMBER})\s*([a-zA-Z%°μu]*)", rf"({NUMBER})\s*([a-zA-Z%°μu]*)\s*{re.escape(a)}\b")]) for v in spec.variables]
        listed = merged_aliases(spec.entities, spec.overrides)
        self.entities = [(flexible(a), name) for a, name in sorted(listed.items(), key=lambda x: -len(x[0]))]
        self.headers = {a.strip().lower(): v for v in spec.variables for a in (v.name, *v.aliases) if a.strip()}

    def entity(self, text: str) -> str:
        """The entity of the longest alias that stands in the text; blank if none does."""
        low = plain(text).lower()
        return next((name for pattern, name in self.entities if pattern.search(low)), "")

    def entity_near(self, parts: list[str], i: int, radius: int) -> str:
        """That of a part, else of the first part within radius that has one."""
        return self.entity(parts[i]) or next((e for p in parts[max(0, i - radius) : i + radius + 1] if (e := self.entity(p))), "")

    def named(self, token: str) -> str:
        """The entity that a token is, or else holds."""
        low = plain(token).strip().lower()
        whole = next((name for pattern, name in self.entities if low and pattern.fullmatch(low)), "")
        return whole or (next((name for pattern, name in self.entities if pattern.search(low)), "") if low else "")

    @staticmethod
    def within(v: Variable, x: float) -> bool:
        if (v.low is not None and x < v.low) or (v.high is not None and x > v.high):
            return False
        name = v.name.lower()
        return not ("thickness" in name and x < 0 or "temperature" in name and x < -273.2)

    @staticmethod
    def hinted(text: str, start: int, end: int, v: Variable) -> bool:
        """Whether a unit of the variable's kind stands near a number; true for other kinds."""
        hint = next((p for word, p in HINTS.items() if word in v.name.lower()), None)
        return hint is None or bool(hint.search(text[max(0, start - HINT_BEFORE) : end + HINT_AFTER]))

    def fits(self, text: str, start: int, end: int, v: Variable, unit: str) -> bool:
        """Whether the unit written at a number is the variable's; without one, variables that need a unit look for it nearby."""
        own = plain(unit).strip().lower()
        if not own:
            return not any(w in v.name.lower() for w in HINTS) or self.hinted(text, start, end, v)
        base = v.unit.strip().lower()
        given = next((x for x in GIVEN_UNITS.values() if base in x), (base,))
        return own in given or re.sub("[^a-z°μuкс]", "", own) in given

    def measured(self, text: str, v: Variable, token: str, unit: str, start: int, end: int) -> tuple[str, float, str] | None:
        """(variable, value, unit) of a number in a text, if it is one of the variable's."""
        token = unsigned(text, token)
        if noisy(text, start, end, token) or not self.fits(text, start, end, v, unit):
            return None
        value, out = plain_change(float(token), unit, v.unit)
        return (v.name, value, out) if self.within(v, value) else None

    def values(self, snippet: str) -> list[tuple[str, float, str]]:
        """Per variable the number at its first alias; if there are none, the number nearest to an alias, with a unit before those without."""
        text, out = plain(snippet), []
        for v, patterns in self.aliases:
            if (m := next((m for p in patterns if (m := p.search(text))), None)) and (one := self.measured(text, v, m[1], m[2], m.start(1), m.end(1))):
                out.append(one)
        return out or [one for v in self.spec.variables if (one := self.nearest(text, v))]

    def nearest(self, text: str, v: Variable) -> tuple[str, float, str] | None:
        low = text.lower()
        places = [m.start() for a in (v.name, *v.aliases) if a for m in re.finditer(re.escape(a.lower()), low)]
        if not places:
            return None
        best = None
        for m in re.finditer(r"(?<![0-9])(-?\d+(?:\.\d+)?)\s*([a-zA-Z°μu]{0,8})", text):
            token, unit = unsigned(text, m[1]), m[2].strip().lower()
            if noisy(text, m.start(1), m.end(1), token) or not self.fits(text, m.start(1), m.end(1), v, unit) or not self.within(v, float(token)):
                continue
            if "thickness" in v.name.lower() and re.search(r"\b(times?|fold)\b", low[max(0, m.start(1) - 12) : m.end(1) + 16]):
                continue
            rank = (not (unit or self.hinted(text, m.start(1), m.end(1), v)), min(abs(m.start(1) - p) for p in places), abs(float(token)))
            if best is None or rank < best[0]:
                best = (rank, float(token), unit)
        if best is None:
            return None
        value, unit = plain_change(best[1], best[2], v.unit)
        return (v.name, value, unit) if self.within(v, value) else None

    def pairs(self, snippet: str) -> list[tuple[str, float, str]]:
        """x and y of phrases such as "for 30 nm … at 350 C"; without any, y of "NiSi forms … 350 C"."""
        if self.x is None or self.y is None:
            return []
        text, out = plain(snippet), []
        for m in FOR_AT.finditer(text):
            x = self.measured(text, self.x, m["x"], m["xu"] or self.x.unit, m.start("x"), m.end("x"))
            y = self.measured(text, self.y, m["y"], m["yu"], m.start("y"), m.end("y"))
            out += [x, y] if x and y else []
        return out or [y for m in PHASE_AT.finditer(text) if (y := self.measured(text, self.y, m["y"], m["yu"], m.start("y"), m.end("y")))]

    def range_mean(self, text: str, a: str, b: str | None) -> float:
        first = float(unsigned(text, a))
        return (first + float(unsigned(text, b))) / 2 if b else first

    def thicknesses(self, text: str) -> list[tuple[float, int, int]]:
        """(value, start, end) of film thicknesses, without repeats in about the same place."""
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        for pattern in THICK:
            for m in pattern.finditer(text):
                start, end = m.start("a"), m.end("b") if m["b"] else m.end("a")
                value = plain_change(self.range_mean(text, m["a"], m["b"]), m["u"], self.x.unit)[0]
                if not noisy(text, start, end, unsigned(text, m["a"])) and self.within(self.x, value):
                    out.setdefault((round(value * 10), start // 8), (value, start, end))
        return list(out.values())

    def mentions(self, text: str) -> list[tuple[str, int, int]]:
        """(entity, start, end) of entities that do not overlap, in order; where some start together the longer alias goes first."""
        found, out = sorted(((name, *m.span()) for p, name in self.entities for m in p.finditer(text)), key=lambda x: x[1]), []
        for one in found:
            if not out or one[1] >= out[-1][2]:
                out.append(one)
        return out

    def events(self, snippet: str) -> list[Event]:
        """Entities with the temperature at which they appear and the nearest thickness; of equal ones the surest."""
        text = plain(snippet)
        if self.x is None or self.y is None or not text.strip():
            return []
        sizes, mentions, found = self.thicknesses(text), self.mentions(text), {}

        def add(token: str, m: re.Match, start: int, end: int, sure: float) -> None:
            name = self.named(token)
            if not name or not sizes or any(s >= start and e <= end and other.lower() != name.lower() for other, s, e in mentions):
                return
            y = plain_change(self.range_mean(text, m["a"], m["b"]), m["u"], self.y.unit)[0]
            x = min(sizes, key=lambda s: abs((s[1] + s[2]) // 2 - start))[0]
            if not self.within(self.y, y) or not self.within(self.x, x):
                return
            sure = min(0.96, max(0.72, sure + 0.03 * bool(m["b"]) + 0.02 * (len(sizes) == 1)))
            key = (name.lower(), round(x * 10), round(y))
            if key not in found or sure > found[key].confidence:
                found[key] = Event(name, x, y, sure)

        last = lambda m: m.end("b") if m["b"] else m.end("a")
        for m in ENTITY_AT.finditer(text):
            add(m["entity"], m, m.start("entity"), last(m), 0.86)
        for m in AT_ENTITY.finditer(text):
            if not any(0 <= m.start("a") - e <= 72 for _, _, e in mentions):  # else it belongs to the entity before it
                add(m["entity"], m, m.start("a"), m.end("entity"), 0.84)
        if not found and mentions and sizes:
            for m in ANY_TEMPERATURE.finditer(text):
                start, end = m.start("a"), last(m)
                if EVENT_WORDS.search(text[max(0, start - 90) : end + 90].lower()):
                    away = lambda x: abs((x[1] + x[2]) // 2 - (start + end) // 2)  # noqa: E731,B023
                    near = min(mentions, key=away)
                    if away(near) <= 260:
                        add(near[0], m, min(start, near[1]), max(end, near[2]), 0.76 if away(near) <= 120 else 0.71)
        return list(found.values())


def sentences(text: str) -> list[str]:
    return [s.strip() for s in SENTENCE.split(re.sub(r"[\r\n]+", " ", text)) if s.strip()]


def windows(text: str, radius: int) -> Iterator[tuple[int, list[str], str]]:
    """Each sentence's number from 0, all sentences, and those within radius of it joined."""
    parts = sentences(text)
    for i in range(len(parts)):
        yield i, parts, " ".join(parts[max(0, i - radius) : i + radius + 1])


def text_engine(text: str, reader: Reader) -> Iterator[Finding]:
    """Values of each sentence window, else its pairs; the entity of the sentence, else of the window."""
    radius = max(1, reader.spec.radius)
    for i, parts, around in windows(text, radius):
        if values := reader.values(around) or reader.pairs(around):
            entity = reader.entity_near(parts, i, radius)
            for name, x, unit in values:
                yield Finding(name, x, unit, entity, "text", f"sentence:{i + 1}", around[:SNIPPET], CONFIDENCE["text"])


def transition_engine(text: str, reader: Reader) -> Iterator[Finding]:
    """The events of each sentence window, as two values each."""
    for i, _, around in windows(text, max(1, reader.spec.radius)):
        for k, e in enumerate(reader.events(around)):
            for name, x, unit in ((reader.x.name, e.x, "nm"), (reader.y.name, e.y, "c")):
                yield Finding(name, x, unit, e.entity, "transition", f"sentence:{i + 1}:transition:{k + 1}:{e.entity}", around[:SNIPPET], e.confidence)


def cells(line: str) -> list[str]:
    """Cells between bars, else commas, else wide gaps."""
    line = line.strip()
    cut = line.split("|") if "|" in line else line.split(",") if "," in line else re.split(r"\s{2,}", line)
    return [c.strip() for c in cut if c.strip()]


def table_engine(text: str, reader: Reader) -> Iterator[Finding]:
    """Numbers under the first line that has a variable's alias as a cell."""
    lines, header, width, n = [x.strip() for x in text.splitlines() if x.strip()], {}, 0, 0
    for line in lines:
        own = cells(line)
        if not header:
            if len(own) >= 2:
                header, width = {k: reader.headers[c.lower()] for k, c in enumerate(own) if c.lower() in reader.headers}, len(own)
            continue
        if len(own) < width:
            continue
        found = []
        for k, v in header.items():
            if m := re.search(NUMBER, own[k]):
                words = own[k].split()
                value, unit = plain_change(float(unsigned(own[k], m[0])), words[-1] if len(words) > 1 else "", v.unit)
                found += [(v.name, value, unit)] if reader.within(v, value) else []
        n += bool(found)
        for name, x, unit in found:
            yield Finding(name, x, unit, reader.entity(line), "table", f"table:1-row:{n}", line[:SNIPPET], CONFIDENCE["table"])


def figure_engine(text: str, reader: Reader) -> Iterator[Finding]:
    """Values within three lines of a line with a figure cue."""
    lines = [x.strip() for x in text.splitlines()]
    for n, line in enumerate(lines):
        if line and any(c in line.lower() for c in reader.spec.cues):
            around = " ".join(x for x in lines[max(0, n - 3) : n + 4] if x)
            if values := reader.values(around):
                entity = reader.entity_near(lines, n, 2)
                for name, x, unit in values:
                    yield Finding(name, x, unit, entity, "figure", f"figure-cue-line:{n + 1}", around[:SNIPPET], CONFIDENCE["figure"])


def salvage(text: str, reader: Reader) -> list[dict]:
    """Pairs of x and y with an entity out of a chunk that a model gave no answer for; distinct by entity, tenth of x and y."""
    out: dict[tuple, dict] = {}
    radius = max(1, reader.spec.radius)
    for i, parts, around in windows(text, radius):
        values = reader.values(around) or reader.pairs(around)
        first = {name: x for name, x, _ in reversed(values)}
        entity = reader.entity_near(parts, i, radius) or reader.entity(around)
        if reader.x and reader.y and entity and reader.x.name in first and reader.y.name in first:
            x, y = first[reader.x.name], first[reader.y.name]
            out.setdefault((entity.lower(), round(x * 10), round(y)), {"entity": entity, "x": x, "y": y, "snippet": around[:SNIPPET], "locator": f"chunk-salvage:sentence:{i + 1}", "confidence": 0.78})
    return list(out.values())


ENGINES: dict[str, Callable[[str, Reader], Iterator[Finding]]] = {"text": text_engine, "transition": transition_engine, "table": table_engine, "figure": figure_engine}
SCHEMA = "point_id string, article_key string, variable_name string, normalized_value double, unit string, entity string, extraction_type string, locator string, snippet string, confidence double"


def enabled(names: list[str] | None = None) -> tuple[str, ...]:
    """Engines by name, all if none is given; text brings transition with it."""
    own = {n.strip().lower() for n in names or ENGINES}
    return tuple(e for e in ENGINES if e in own or e == "transition" and "text" in own)


def point_id(article: str, f: Finding) -> str:
    return hashlib.sha1(f"{article}|{f.engine}|{f.locator}|{f.snippet[:ID_SNIPPET]}".encode()).hexdigest()[:20]


def extract(docs: DataFrame, spec: Spec, engines: tuple[str, ...] = tuple(ENGINES), key: str = "article_key", text: str = "text") -> DataFrame:
    """Evidence rows in long form; a point is what one engine finds in one place. Null texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(spec)
        for batch in batches:
            rows = [(point_id(k, f), k, f.variable, f.value, f.unit, f.entity, f.engine, f.locator, f.snippet, f.confidence) for k, t in zip(batch["k"], batch["t"]) if t and t.strip() for name in engines for f in ENGINES[name](t, reader)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, SCHEMA)


def salvaged(chunks: DataFrame, spec: Spec, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """The salvaged pairs of each chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(spec)
        for batch in batches:
            yield pd.DataFrame([(k, *p.values()) for k, t in zip(batch["k"], batch["t"]) for p in salvage(t or "", reader)], columns=["chunk_id", "entity", "x", "y", "snippet", "locator", "confidence"])

    return chunks.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, "chunk_id string, entity string, x double, y double, snippet string, locator string, confidence double")


def coverage(docs: DataFrame, points: DataFrame, key: str = "article_key") -> DataFrame:
    """Per document the points and variables found, and why there are none."""
    n = points.groupBy("article_key").agg(F.countDistinct("point_id").alias("matched_points"), F.countDistinct("variable_name").alias("matched_variables"))
    out = docs.select(F.col(key).cast("string").alias("article_key"), F.col("text")).join(n, "article_key", "left")
    out = out.withColumns({"matched_points": F.coalesce("matched_points", F.lit(0)), "matched_variables": F.coalesce("matched_variables", F.lit(0))})
    why = F.when(F.trim(F.coalesce("text", F.lit(""))) == "", "empty_text").when(F.col("matched_points") == 0, "no_match").when(F.col("matched_variables") < 2, "single_variable").otherwise("")
    return out.select("article_key", "matched_points", "matched_variables", why.alias("drop_reason"))
