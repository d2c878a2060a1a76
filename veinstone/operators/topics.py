"""Topic plugins: query expansion, boosts and aliases of a field of research, by name."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veinstone.functions.text import STOPWORDS, blank


@dataclass(frozen=True)
class Topic:
    """What a topic adds to discovery and extraction. Weights are per hit, the most for hits, per extra group, and of negative terms alone."""

    name: str
    entity_terms: tuple[str, ...] = ()
    negative_terms: tuple[str, ...] = ()
    queries: tuple[str, ...] = ()
    extras: tuple[tuple[str, ...], ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    hit: float = 0.12
    most: float = 0.45
    extra: float = 0.08
    penalty: float = 0.28

    def expand(self, query: str, keywords: list[str]) -> list[str]:
        return distinct([query, *self.queries, " ".join(keywords)])

    def boost(self, title: Column, abstract: Column) -> Column:
        """Entity terms found, up to a limit, extra groups found, less the penalty for negative terms without any entity term."""
        low = F.lower(F.concat_ws(" ", blank(title), blank(abstract)))
        any_of = lambda terms: reduce(lambda a, b: a | b, [low.contains(t) for t in terms], F.lit(False))
        hits = sum((low.contains(t).cast("int") for t in self.entity_terms), F.lit(0))
        gain = F.least(hits * self.hit, F.lit(self.most)) + sum((F.when(any_of(g), self.extra).otherwise(0.0) for g in self.extras), F.lit(0.0))
        return gain - F.when(any_of(self.negative_terms) & (hits == 0), self.penalty).otherwise(0.0)


def distinct(queries: list[str]) -> list[str]:
    """Queries with runs of blanks as one, without blank and repeated ones."""
    return list(dict.fromkeys(q for q in (" ".join(x.split()) for x in queries) if q))


#: The topic of nickel silicides.
SILICIDES = Topic(
    "materials_ni_silicide",
    entity_terms=("ni2si", "nisi", "nisi2", "nickel silicide", "ni silicide"),
    negative_terms=("hfo2", "hafnia", "ferroelectric", "zro2", "zr-doped", "undoped-hfo2"),
    queries=("nickel silicide phase formation thin film annealing", "Ni2Si NiSi NiSi2 thickness temperature", "nickel film silicon reaction temperature phase sequence", "Ni silicide transformation temperature thickness dependence"),
    extras=(("thickness",), ("anneal", "annealing", "temperature")),
    aliases={"ni₂si": "Ni2Si", "ni si": "NiSi", "ni-si": "NiSi", "ni si2": "NiSi2", "ni-si2": "NiSi2", "nickel monosilicide": "NiSi", "nickel disilicide": "NiSi2"},
)
LOADERS: dict[str, Callable[[], Topic]] = {name: lambda: SILICIDES for name in ("materials_ni_silicide", "ni_silicide", "ni-silicide")}


def load(name: str) -> Topic | None:
    """The topic of a name, whatever its case; None for others."""
    loader = LOADERS.get(name.strip().lower())
    return loader() if loader else None


def expand_queries(query: str, keywords: list[str], extra: list[str] = (), topic: Topic | None = None, most: int = 20) -> list[str]:
    """The topic's queries, the query, extra ones, the keywords, and their first six tokens if there are at least three; distinct, in that order."""
    blob = " ".join(keywords).strip()
    tokens = [w for w in re.findall("[a-z0-9]+", blob.lower()) if w not in STOPWORDS and len(w) > 1]
    out = distinct([*(topic.expand(query, keywords) if topic else []), query, *extra])
    out += [q for q in dict.fromkeys([blob, " ".join(tokens[:6]) if len(tokens) >= 3 else ""]) if q and q not in out]
    return out[:most]


def merged_aliases(entities: dict[str, tuple[str, ...]], *overrides: dict[str, str]) -> dict[str, str]:
    """Lower-case alias to entity, of a specification and then of overrides, of which later ones win."""
    out = {a.strip().lower(): name for name, aliases in entities.items() for a in (name, *aliases) if a.strip()}
    for extra in overrides:
        out |= {a.strip().lower(): name.strip() for a, name in extra.items() if a.strip() and name.strip()}
    return out
