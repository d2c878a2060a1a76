"""Expressions over measured quantities and formulas: units, buckets, scores, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veinstone.functions.text import blank

#: Spellings of units, by unit.
UNIT_ALIASES = {
    "c": ["°c", "oc", "degc", "celsius"],
    "k": ["k", "kelvin"],
    "nm": ["nm", "nanometer", "nanometers"],
    "um": ["um", "μm", "micrometer"],
    "mm": ["mm"],
    "ev": ["ev"],
    "mev": ["mev"],
}
#: Fixed values: (from, to, factor, offset) of value * factor + offset.
UNIT_CHANGES = [("k", "c", 1.0, -273.15), ("c", "k", 1.0, 273.15), ("um", "nm", 1000.0, 0.0), ("mm", "nm", 1000000.0, 0.0), ("nm", "um", 0.001, 0.0), ("mev", "ev", 0.001, 0.0)]


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def canonical_unit(unit: Column) -> Column:
    low = F.replace(F.lower(F.trim(blank(unit))), F.lit(" "), F.lit(""))
    known = reduce(lambda w, kv: w.when(low.isin(*kv[1]), F.lit(kv[0])), UNIT_ALIASES.items(), F.when(F.lit(False), low))
    return known.otherwise(low)


def plain_unit(unit: str) -> str:
    """canonical_unit of a text."""
    low = unit.strip().lower().replace(" ", "")
    return next((name for name, spelled in UNIT_ALIASES.items() if low in spelled), low)


def plain_change(value: float, unit: str, target: str) -> tuple[float, str]:
    """normalise_value of numbers and texts."""
    own, goal = plain_unit(unit), plain_unit(target)
    if not goal or own == goal:
        return value, goal or own
    hit = next((c for c in UNIT_CHANGES if c[:2] == (own, goal)), None)
    return (value * hit[2] + hit[3], goal) if hit else (value, own or goal)


def normalise_value(value: Column, unit: Column, target: str) -> Column:
    """struct(value, unit): in the target unit if the change is known, else as it came; a missing unit is taken for the target."""
    own, goal = canonical_unit(unit), plain_unit(target)
    out = lambda v, u: F.struct(v.alias("value"), u.alias("unit"))
    same = F.when((own == goal) | (own == ""), out(value, F.lit(goal))) if goal else F.when(F.lit(True), out(value, own))
    return reduce(lambda w, c: w.when(own == c[0], out(value * c[2] + c[3], F.lit(goal))), [c for c in UNIT_CHANGES if c[1] == goal], same).otherwise(out(value, own))


def bucket(value: Column, ladder: tuple, missing: float = 0.0) -> Column:
    """The label of a ladder (lowest label, test of it, [(bound, label)], last label, whether bounds are included) for a value; null and NaN count as missing."""
    lowest, test, steps, last, inclusive = ladder
    v = F.coalesce(F.when(F.isnan(value), F.lit(None)).otherwise(value), F.lit(missing)).cast("double")
    below = (lambda b: v <= b) if inclusive else (lambda b: v < b)
    return reduce(lambda w, s: w.when(below(s[0]), F.lit(s[1])), steps, F.when(v <= 0 if test == "<=0" else v < 0, F.lit(lowest))).otherwise(last)


#: The regimes' labels and cut points.
TEMPERATURE = ("unknown_temperature_regime", "<=0", [(200.0, "temp_regime_low"), (450.0, "temp_regime_mid"), (750.0, "temp_regime_high")], "temp_regime_extreme", False)
TIME = ("unknown_time_regime", "<=0", [(30.0, "time_regime_short"), (600.0, "time_regime_medium"), (3600.0, "time_regime_long")], "time_regime_very_long", False)
PRESSURE = ("unknown_pressure_regime", "<=0", [(100.0, "pressure_regime_high_vacuum"), (1e4, "pressure_regime_low_pressure"), (5e4, "pressure_regime_mid_pressure")], "pressure_regime_atm_like", False)
STABILITY = ("stability_unknown", "<=0", [(0.05, "stability_stable"), (0.10, "stability_metastable")], "stability_unstable", True)
HULL = ("energy_hull_unknown", "<=0", [(0.05, "energy_hull_0_0p05"), (0.10, "energy_hull_0p05_0p10"), (0.30, "energy_hull_0p10_0p30")], "energy_hull_gt_0p30", True)


def bandgap_bucket(value: Column) -> Column:
    """Missing values count as -1, that is unknown."""
    v = F.coalesce(F.when(F.isnan(value), F.lit(None)).otherwise(value), F.lit(-1.0)).cast("double")
    return F.when(v < 0, "bandgap_unknown").when(v == 0, "bandgap_metallic").when(v < 1, "bandgap_narrow").when(v < 3, "bandgap_mid").otherwise("bandgap_wide")


def metallicity(is_metal: Column) -> Column:
    low = F.lower(F.trim(blank(is_metal.cast("string"))))
    return F.when(low.isin("true", "1", "yes", "metal"), "metallic").when(low.isin("false", "0", "no", "insulator"), "non_metallic").otherwise("metallicity_unknown")


def url_quality(url: Column) -> Column:
    """By the URL's end; XML also by a format parameter."""
    low = F.lower(F.trim(blank(url)))
    return F.when(low == "", 0.0).when(low.endswith(".pdf"), 1.0).when(low.endswith(".xml") | low.contains("format=xml"), 0.9).when(low.endswith(".txt") | low.endswith(".html"), 0.8).when(low.contains("doi.org"), 0.55).otherwise(0.65)


def fulltext_mime(mime: Column, url: Column) -> Column:
    """JSON never; PDF, XML, HTML and text always; anything else by the URL's suffix."""
    m = F.lower(blank(mime))
    return F.when(m.contains("json"), False).when(m.rlike("pdf|xml|html|text/"), True).otherwise(F.lower(blank(url)).rlike(r"\.(pdf|xml|html?|txt)([?#].*)?$"))


def interpretation(score: Column, formula: Column, n_refs: Column) -> Column:
    return F.when(n_refs == 0, "insufficient").when(score >= 0.70, "supports").when((score <= 0.35) & (formula < 0.40), "conflicts").otherwise("neutral")


def conflict_reason(label: Column, formula: Column, stability: Column) -> Column:
    """Why a label is `conflicts`; blank for others."""
    return F.when(label != "conflicts", "").when(formula < 0.40, "formula_mismatch").when(stability <= 0.40, "low_stability").otherwise("low_alignment")


def formula_match(own: Column, other: Column) -> Column:
    """1 for equal formulas, .85 for equal element sets, .55 for shared elements."""
    a, b = elements(own), elements(other)
    return F.when((own == other) & (blank(own) != ""), 1.0).when((F.size(a) > 0) & (F.array_sort(a) == F.array_sort(b)), 0.85).when(F.arrays_overlap(a, b), 0.55).otherwise(0.0)


def stability_match(hull: Column) -> Column:
    return F.when(hull.isNull(), 0.0).when(hull <= 0.05, 1.0).when(hull <= 0.10, 0.7).otherwise(0.4)


def reference_score(formula: Column, hull: Column) -> Column:
    phase = F.when(formula == 1.0, 1.0).when(formula > 0, 0.6).otherwise(0.0)
    return 0.5 * formula + 0.3 * phase + 0.2 * stability_match(hull)


def bridge_weight(confidence: Column, provenance: Column, proximity: Column, agreement: Column, support: Column) -> Column:
    return clamp(0.35 * confidence + 0.20 * provenance + 0.15 * proximity + 0.15 * agreement + 0.15 * support)


def element_tokens(formula: Column) -> Column:
    return F.regexp_extract_all(blank(formula), F.lit("([A-Z][a-z]?)([0-9]*\\.?[0-9]*)"), F.lit(1))


def elements(formula: Column) -> Column:
    return F.array_distinct(element_tokens(formula))


def stoichiometry(formula: Column) -> Column:
    """struct(element, ratio) in order; a missing ratio is 1."""
    counts = F.regexp_extract_all(blank(formula), F.lit("([A-Z][a-z]?)([0-9]*\\.?[0-9]*)"), F.lit(2))
    return F.transform(F.arrays_zip(element_tokens(formula).alias("e"), counts.alias("n")), lambda x: F.struct(x["e"].alias("element"), F.coalesce(F.nullif(x["n"], F.lit("")).try_cast("double"), F.lit(1.0)).alias("ratio")))


def is_formula(text: Column) -> Column:
    """At least two element tokens that together spell the whole text."""
    whole = F.regexp_extract_all(blank(text), F.lit("[A-Z][a-z]?[0-9]*\\.?[0-9]*"), F.lit(0))
    return (F.size(whole) >= 2) & (F.array_join(whole, "") == blank(text))


def plain_digits(text: Column) -> Column:
    """Subscript digits as plain ones."""
    return F.translate(blank(text), "₀₁₂₃₄₅₆₇₈₉", "0123456789")


def rebuilt(text: Column) -> Column:
    """The element tokens of a text, one after another."""
    return F.array_join(F.regexp_extract_all(text, F.lit(r"[A-Z][a-z]?[0-9]*(?:\.[0-9]+)?"), F.lit(0)), "")


def reduced_formula(text: Column) -> Column:
    """The formula that a label spells, blanks, hyphens and other marks aside; blank if it spells more than a formula."""
    compact = F.regexp_replace(blank(text), "[^A-Za-z0-9.]", "")
    whole = rebuilt(compact)
    return F.when(F.lower(whole) == F.lower(compact), whole).otherwise("")


def strict_formula(text: Column, symbols: list[str]) -> Column:
    """A formula of at least two tokens, all of them chemical elements; blank otherwise. Subscripts count as digits."""
    compact = F.regexp_replace(plain_digits(F.trim(blank(text))), "[^A-Za-z0-9]", "")
    names = F.regexp_extract_all(compact, F.lit("([A-Z][a-z]?)[0-9]*"), F.lit(1))
    fine = compact.rlike("^(?:[A-Z][a-z]?[0-9]*){2,}$") & (F.size(F.array_except(names, F.array(*[F.lit(x) for x in symbols]))) == 0)
    return F.when(fine, compact).otherwise("")


def formula_tokens(text: Column, symbols: list[str]) -> Column:
    """The formulas in a text, in order: written in one, then with blanks between their parts."""
    t = plain_digits(blank(text))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in (r"\b(?:[A-Z][a-z]?[0-9]*){2,}\b", r"\b(?:[A-Z][a-z]?\s*[0-9]*\s*){2,4}\b")])
    return F.array_distinct(F.filter(F.transform(found, lambda x: strict_formula(x, symbols)), lambda x: x != ""))


def spacegroup_symbol(text: Column) -> Column:
    return F.regexp_replace(F.trim(blank(text.cast("string"))), "[^A-Za-z0-9]", "")


def spacegroup_number(text: Column) -> Column:
    return F.regexp_replace(blank(text.cast("string")), "[^0-9]", "")


def spacegroup_tokens(text: Column) -> Column:
    """The text, its parts and their digits, in lower case."""
    low = F.lower(F.trim(blank(text.cast("string"))))
    parts = F.array_union(F.array(low), F.split(low, r"[\s,/;_-]+"))
    return F.filter(F.array_union(parts, F.transform(parts, lambda x: F.regexp_replace(x, "[^0-9]", ""))), lambda x: x != "")


def crystal_system(number: Column) -> Column:
    """Of a space group by its number; what has none is unknown."""
    return F.when(number.isNull(), "unknown_crystal_system").when(number <= 2, "triclinic").when(number <= 15, "monoclinic").when(number <= 74, "orthorhombic").when(number <= 142, "tetragonal").when(number <= 167, "trigonal").when(number <= 194, "hexagonal").otherwise("cubic")


def first_quantity(text: Column, pattern: str, factors: dict[str, float]) -> Column:
    """The first number with a unit in a text, times the unit's factor; null without one."""
    value, unit = F.regexp_extract(blank(text), pattern, 1).try_cast("double"), F.lower(F.regexp_extract(blank(text), pattern, 2))
    return value * reduce(lambda w, kv: w.when(unit == kv[0], F.lit(kv[1])), factors.items(), F.when(F.lit(False), F.lit(0.0)))


#: Units of time and of pressure, by spelling.
SECONDS = {"s": 1.0, "sec": 1.0, "second": 1.0, "seconds": 1.0, "min": 60.0, "minute": 60.0, "minutes": 60.0, "h": 3600.0, "hr": 3600.0, "hour": 3600.0, "hours": 3600.0}
PASCALS = {"pa": 1.0, "kpa": 1000.0, "mpa": 1000000.0, "bar": 100000.0, "mbar": 100.0, "torr": 133.322}


def quantity_pattern(units: dict[str, float]) -> str:
    return rf"(?i)([0-9]+(?:\.[0-9]+)?)\s*({'|'.join(units)})\b"


def seconds_in(text: Column) -> Column:
    """The first duration in the text, in seconds."""
    return first_quantity(text, quantity_pattern(SECONDS), SECONDS)


def pascals_in(text: Column) -> Column:
    """The first pressure in the text, in pascals."""
    return first_quantity(text, quantity_pattern(PASCALS), PASCALS)


def strain_in(text: Column) -> Column:
    """The first percentage of a text that speaks of strain or stress."""
    return F.when(F.lower(blank(text)).rlike("strain|stressed"), F.nullif(F.regexp_extract(blank(text), r"(-?[0-9]+(?:\.[0-9]+)?)\s*%", 1), F.lit("")).try_cast("double"))


def vacancies_in(text: Column) -> Column:
    """The first concentration per cubic centimetre of a text that speaks of vacancies."""
    return F.when(F.lower(blank(text)).contains("vacanc"), F.nullif(F.regexp_extract(blank(text), r"(?i)([0-9]+(?:\.[0-9]+)?)\s*(?:cm-?3|cm\^-3)", 1), F.lit("")).try_cast("double"))


#: What a text must hold for a label; the first that fits counts.
QUALITY_LABELS = (("high_crystallinity", ("epitax", "single crystal", "highly ordered")), ("degraded", ("agglomer", "rough", "void", "defect")), ("uniform", ("uniform", "stable", "smooth")))
METHOD_LABELS = (("PVD", ("sputter", "evaporat", "e-beam", "physical vapor")), ("ALD", ("atomic layer deposition", "ald")), ("CVD", ("cvd", "chemical vapor")), ("ANNEAL", ("anneal", "rapid thermal")))


def first_label(text: Column, labels: tuple, other: str) -> Column:
    low = F.lower(blank(text))
    return reduce(lambda w, kv: w.when(reduce(lambda a, b: a | b, [low.contains(x) for x in kv[1]]), F.lit(kv[0])), labels, F.when(F.lit(False), F.lit(""))).otherwise(other)


def quality_label(text: Column) -> Column:
    return first_label(text, QUALITY_LABELS, "unknown")


def method_family(text: Column) -> Column:
    return first_label(text, METHOD_LABELS, "")


def first_composition(*columns: Column) -> Column:
    """The value of the first item of the first of the JSON lists that has one."""
    item = lambda c: F.get(F.from_json(blank(c), "array<struct<value: double>>", {"allowSingleQuotes": "false"}), F.lit(0))["value"]
    return F.coalesce(*[item(c) for c in columns])


def jitter(*parts: Column, digits: int = 6) -> Column:
    """A number from 0 to 1 out of the first hex digits of the parts' SHA-1."""
    head = F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, digits)
    return F.conv(head, 16, 10).cast("double") / float(16**digits - 1)


def orientation(text: Column) -> Column:
    """The first Miller index triple in any kind of bracket, as (hkl)."""
    hit = F.regexp_extract(blank(text), r"[\(\[<{]\s*([01-9]{3})\s*[\)\]>}]", 1)
    return F.when(hit != "", F.concat(F.lit("("), hit, F.lit(")"))).otherwise("")


def doping_state(text: Column) -> Column:
    low = F.lower(blank(text))
    return F.when(low.rlike(r"\bundoped\b|\bno (?:intentional )?dop|\bwithout dop"), "undoped").when(low.rlike(r"\bdop(?:ed|ing|ant)\b"), "doped").otherwise("")


def context_score(substrate: Column, orientation_: Column, doping: Column, alloy: Column, pure: Column) -> Column:
    has = lambda c, w: F.when(F.trim(blank(c)) != "", w).otherwise(0.0)
    return F.least(has(substrate, 0.30) + has(orientation_, 0.25) + has(doping, 0.20) + has(alloy, 0.20) + F.when(pure, 0.05).otherwise(0.0), F.lit(1.0))
