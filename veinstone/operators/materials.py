"""Material identities, reference materials and how points agree with them."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions import science
from veinstone.functions.text import blank, json_list
from veinstone.operators.context import ELEMENTS
from veinstone.operators.validation import text_of

#: Labels that name no entity.
NO_ENTITY = ("", "unknown", "na", "n/a", "none", "null")
#: Columns that may name a material, the first that does counts.
NAMING = ("entity", "phase_label", "film_material", "target_film_material")


def resolved_formula(name: Column, aliases: dict[str, str]) -> Column:
    """A label's formula: itself, that of an alias it is, or of the first alias that it holds."""
    low = F.lower(F.trim(blank(name)))
    own = F.nullif(science.strict_formula(name, ELEMENTS), F.lit(""))
    spelled = {a: f for a, f in aliases.items() if a}
    by_name = F.coalesce(*[F.when(low == a, F.nullif(science.strict_formula(F.lit(f), ELEMENTS), F.lit(""))) for a, f in spelled.items()], F.lit(None).cast("string"))
    within = F.coalesce(*[F.when(low.contains(a), F.nullif(science.strict_formula(F.lit(f), ELEMENTS), F.lit(""))) for a, f in spelled.items()], F.lit(None).cast("string"))
    return F.coalesce(own, F.when(low.isin(*NO_ENTITY), F.lit(None)).otherwise(F.coalesce(by_name, within)))


def identities(points: DataFrame, aliases: dict[str, str], scope: str = "summary_thermo") -> DataFrame:
    """Per point (first row given) formula, phase target, doping signature and query key; points of one material share the key."""
    named = [resolved_formula(F.col(c), aliases) for c in NAMING if c in points.columns]
    tokens = science.formula_tokens(text_of(points, "snippet"), ELEMENTS)
    formula = F.coalesce(*named, F.get(tokens, F.lit(0)), F.lit(""))
    target = F.coalesce(*[F.nullif(x, F.lit("")) for x in (formula, text_of(points, "entity"), text_of(points, "phase_label"), text_of(points, "film_material"))], F.lit(""))
    states = [F.when(text_of(points, c) != "", F.concat(F.lit(f"{c}:"), F.lower(text_of(points, c)))) for c in ("doping_state", "alloy_state")]
    lists = [F.when(F.size(json_list(F.col(c))) > 0, F.concat(F.lit(f"{c}:"), F.array_join(F.array_sort(F.array_distinct(json_list(F.col(c)))), ","))) for c in ("doping_elements", "alloy_elements") if c in points.columns]
    out = points.withColumns({"formula": formula, "phase_target_type": F.lit("phase_label"), "phase_target_value": target, "doping_signature": F.concat_ws("|", *states, *lists)})
    key = F.concat_ws("|", "formula", "phase_target_type", "phase_target_value", "doping_signature", F.lit(scope))
    return out.withColumn("query_key", F.sha1(key.cast("binary"))).select("point_id", "formula", "phase_target_type", "phase_target_value", "doping_signature", "query_key")


REFERENCE = "material_id string, formula_pretty string, spacegroup_symbol string, spacegroup_number string, crystal_system string, energy_above_hull double, is_theoretical boolean"


def reference_status(enabled: bool, api_key: str, endpoint: str) -> str | None:
    """Why the reference service is not asked; None if it is."""
    return "disabled" if not enabled else "no_api_key" if not api_key.strip() else "invalid_endpoint" if not endpoint.strip().rstrip("/") else None


def documents_of(payload: object) -> list[dict]:
    """The records of a reply, in any of its envelopes."""
    if not isinstance(payload, dict):
        return []
    for found in (payload.get("data"), payload.get("response"), (payload.get("response") or {}).get("docs") if isinstance(payload.get("response"), dict) else None):
        if isinstance(found, list):
            return [x for x in found if isinstance(x, dict)]
    return []


def reference_of(record: dict) -> tuple:
    symmetry = record.get("symmetry") if isinstance(record.get("symmetry"), dict) else {}
    first = lambda *xs: str(next((x for x in xs if x), ""))
    hull = record.get("energy_above_hull")
    return (
        first(record.get("material_id"), record.get("material_ids")), first(record.get("formula_pretty"), record.get("formula")), first(symmetry.get("symbol"), record.get("spacegroup_symbol")), first(symmetry.get("number"), record.get("spacegroup_number")),
        first(symmetry.get("crystal_system"), record.get("crystal_system")), float(hull) if isinstance(hull, (int, float)) else None, bool(record.get("theoretical") or record.get("is_theoretical")),
    )


def fetch_references(queries: DataFrame, client: str, enabled: bool = True, api_key: str = "", endpoint: str = "https://api.materialsproject.org", most: int = 100, thermo: bool = True) -> DataFrame:
    """(query_key, status, error, references) of queries (query_key, formula): one request a query, and one a material for its energy.

    client names a function (url, parameters, key) -> (HTTP status, body). Failures are rows with a
    status of their own: disabled, no_api_key, invalid_endpoint, fetch_error, parse_error; else success.
    """
    off, base, most = reference_status(enabled, api_key, endpoint), endpoint.strip().rstrip("/"), max(1, min(most, 500))

    def asked(call: Callable, formula: str) -> tuple[str, str, list]:
        try:
            code, body = call(f"{base}/materials/summary/", {"formula": formula, "_fields": "material_id,formula_pretty,symmetry,energy_above_hull,theoretical", "_limit": most}, api_key)
        except Exception as e:
            return "fetch_error", f"{type(e).__name__}: {e}", []
        if code >= 400:
            return "fetch_error", f"http_{code}: {body[:200].strip()}", []
        try:
            found = [reference_of(x) for x in documents_of(json.loads(body))][:most]
        except ValueError as e:
            return "parse_error", f"{type(e).__name__}: {e}", []
        return "success", "", [with_energy(call, r) for r in found] if thermo else found

    def with_energy(call: Callable, r: tuple) -> tuple:
        if not r[0]:
            return r
        try:
            code, body = call(f"{base}/materials/thermo/", {"material_ids": r[0], "_fields": "material_id,energy_above_hull", "_limit": 1}, api_key)
            hull = next((float(x["energy_above_hull"]) for x in documents_of(json.loads(body)) if x.get("material_id") == r[0]), r[5]) if code < 400 else r[5]
        except Exception:
            hull = r[5]
        return (*r[:5], hull, r[6])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = client.partition(":")
        call = None if off else getattr(importlib.import_module(module), name)
        names = [c.split()[0] for c in REFERENCE.split(", ")]
        for batch in batches:
            rows = [(k, *((off, "", []) if off else asked(call, f))) for k, f in zip(batch["query_key"], batch["formula"])]
            yield pd.DataFrame([(k, s, e, [dict(zip(names, r)) for r in found]) for k, s, e, found in rows], columns=["query_key", "status", "error", "references"])

    return queries.select("query_key", "formula").distinct().mapInPandas(run, f"query_key string, status string, error string, references array<struct<{REFERENCE.replace(' string', ': string').replace(' double', ': double').replace(' boolean', ': boolean')}>>")


def matching_target(references: DataFrame, target_type: Column, target: Column) -> DataFrame:
    """References that fit a phase target: of space group targets those that share a token with it, of others all."""
    shared = F.arrays_overlap(science.spacegroup_tokens(target), F.array_union(science.spacegroup_tokens(F.col("spacegroup_symbol")), science.spacegroup_tokens(F.col("spacegroup_number"))))
    return references.where((blank(target) == "") | (F.lower(blank(target_type)) != "space_group") | shared)


def interpreted(identity: DataFrame, references: DataFrame) -> DataFrame:
    """Per point its best reference (by score, formula, id) with scores, label and reason; points without references are insufficient.

    references: one row a reference with its query_key. Rows meet on the key, so that hot materials
    split by adaptive execution; only scores reach the ranking.
    """
    f = science.formula_match(F.col("formula"), F.col("formula_pretty"))
    every = identity.select("point_id", "query_key", "formula").join(references.select("query_key", "material_id", "formula_pretty", "energy_above_hull"), "query_key", "left").withColumn("formula_score", f)
    scored = every.withColumn("score", science.reference_score(F.col("formula_score"), F.col("energy_above_hull"))).withColumn("stability", science.stability_match(F.col("energy_above_hull")))
    order = F.struct((-F.round("score", 9)).alias("s"), (-F.col("formula_score")).alias("f"), "material_id")
    has = F.col("material_id").isNotNull()
    best = scored.groupBy("point_id").agg(F.min_by(F.struct("material_id", "score", "formula_score", "stability", "energy_above_hull"), F.when(has, order)).alias("b"), F.count_if(has).alias("n"))
    label = science.interpretation(F.round("b.score", 9), F.col("b.formula_score"), F.col("n"))
    out = best.select("point_id", F.col("n").alias("mp_references"), F.col("b.material_id").alias("mp_best_material_id"), F.coalesce("b.score", F.lit(0.0)).alias("mp_interpretation_score"), F.coalesce("b.formula_score", F.lit(0.0)).alias("mp_formula_match_score"), F.coalesce("b.stability", F.lit(0.0)).alias("mp_stability_score"), F.col("b.energy_above_hull").alias("mp_energy_above_hull_min"), label.alias("mp_interpretation_label"))
    return out.withColumn("mp_conflict_reason", science.conflict_reason(F.col("mp_interpretation_label"), F.col("mp_formula_match_score"), F.col("mp_stability_score")))


def reference_bonus(candidate: Column, label: Column, target: str, target_type: str, target_value: str, references: list[dict]) -> Column:
    """What references add to a candidate's score: for its formula, and for the target's phase; 0 without references. references is a request's own short list."""
    if not references:
        return F.lit(0.0)
    canonical = lambda x: "".join(str(x or "").split()).lower()
    goal, phase, kind = canonical(target), target_value.strip().lower(), target_type.strip().lower()
    own = F.lower(F.regexp_replace(F.coalesce(F.nullif(F.trim(blank(candidate)), F.lit("")), F.nullif(F.trim(blank(label)), F.lit("")), F.lit(target)), r"\s+", ""))
    formulas = [canonical(r.get("formula_pretty")) for r in references if canonical(r.get("formula_pretty"))]
    hit = F.lit(any(goal in f for f in formulas))
    for f in formulas:
        hit = hit | F.lit(f).contains(own)
    bonus = F.when(hit, 0.04).otherwise(-0.04)
    if kind == "space_group":
        tokens = lambda x: {t for p in [str(x or "").strip().lower(), *str(x or "").strip().lower().replace(",", " ").replace("/", " ").replace(";", " ").replace("_", " ").replace("-", " ").split()] for t in (p, "".join(c for c in p if c.isdigit())) if t}
        fits = any(tokens(phase) & (tokens(r.get("spacegroup_symbol")) | tokens(r.get("spacegroup_number"))) for r in references)
        bonus = bonus + (0.04 if fits else -0.05)
    elif kind == "phase_label":
        low = F.lower(F.trim(blank(label)))
        fits = (low.contains(phase) | F.lit(any(phase in f for f in formulas))) if phase else F.lit(False)
        bonus = bonus + F.when(fits, 0.02).otherwise(-0.01)
    return science.clamp(bonus, -0.12, 0.12)


def first_rows(points: DataFrame, order: str, key: str = "point_id") -> DataFrame:
    """The first row of each point by order."""
    w = Window.partitionBy(key).orderBy(order)
    return points.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
