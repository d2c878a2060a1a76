"""Validation of evidence rows: reason codes, context, references, gates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.functions.text import blank, filled
from veinstone.operators.evidence import reasons

#: States of doping and alloying that count as known.
DOPING_STATES = ("doped", "undoped", "na_pure_ni")
ALLOY_STATES = ("alloyed", "pure", "na_pure_ni")
CONTEXT_FIELDS = ("substrate_material", "substrate_orientation", "doping_state", "alloy_state")
#: Reasons that speak of context.
CONTEXT_REASONS = "substrate|orientation|doping|alloy|composition|pure_ni"


@dataclass(frozen=True)
class Rules:
    """bounds: per variable the least and the greatest value, None for none; thresholds: least confidence by extraction type."""

    bounds: dict[str, tuple[float | None, float | None]]
    thresholds: dict[str, float] = field(default_factory=dict)
    min_confidence: float = 0.65
    provenance: tuple[str, ...] = ("citation_url", "snippet", "locator")
    assembled_floor: float = 0.0
    context: bool = False
    phase_elements: bool = True
    phase_stoichiometry: bool = True
    phase_spacegroup: bool = True
    reference_mode: str = "interpreter"


def text_of(rows: DataFrame, *names: str) -> Column:
    """The first of the columns that exist and are not blank, trimmed; blank if none is."""
    own = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in rows.columns]
    return F.coalesce(*own, F.lit(""))


def in_range(name: Column, value: Column, bounds: dict[str, tuple[float | None, float | None]]) -> Column:
    """Within the variable's bounds; no thickness below 0, no temperature below absolute zero."""
    ok = F.lit(True)
    for v, (low, high) in bounds.items():
        own = (F.lit(True) if low is None else value >= low) & (F.lit(True) if high is None else value <= high)
        ok = F.when(name == v, own).otherwise(ok)
    return ok & ~(F.lower(name).contains("thickness") & (value < 0)) & ~(F.lower(name).contains("temperature") & (value < -273.2))


def context_checks(rows: DataFrame) -> list[tuple[str, Column]]:
    """What a row's material context lacks."""
    doping, alloy = F.lower(text_of(rows, "doping_state")), F.lower(text_of(rows, "alloy_state"))
    evidence = F.coalesce(F.col("pure_ni_evidence").cast("boolean"), F.lit(False)) if "pure_ni_evidence" in rows.columns else F.lit(False)
    no_list = lambda c: (blank(F.col(c)) != "") & (F.try_parse_json(F.col(c)).isNull() | (F.schema_of_variant(F.try_parse_json(F.col(c))).startswith("ARRAY") == F.lit(False)))
    compositions = [no_list(c) for c in ("doping_composition", "alloy_composition") if c in rows.columns]
    return [
        ("missing_substrate", text_of(rows, "substrate_material") == ""),
        ("missing_orientation", text_of(rows, "substrate_orientation") == ""),
        ("missing_doping_context", ~doping.isin(*DOPING_STATES)),
        ("missing_alloy_context", ~alloy.isin(*ALLOY_STATES)),
        ("pure_ni_exception_not_supported_by_evidence", ((doping == "na_pure_ni") | (alloy == "na_pure_ni")) & ~evidence),
        *[("invalid_composition_format", F.coalesce(c, F.lit(True))) for c in compositions],
    ]


def reference_conflict(rows: DataFrame) -> Column:
    return F.lower(text_of(rows, "mp_interpretation_label")) == "conflicts"


def checks(rows: DataFrame, rules: Rules) -> list[tuple[str, Column]]:
    """All codes with their conditions for joined rows (evidence with provenance, whose clashing columns end in _prov)."""
    value = F.col("normalized_value").try_cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    known = F.col("variable_name").isin(*rules.bounds)
    confidence = F.coalesce(F.col("confidence").cast("double"), F.lit(0.0))
    kind = F.lower(text_of(rows, "extraction_type"))
    least = F.lit(float(rules.min_confidence))
    for t, x in rules.thresholds.items():
        least = F.when(kind == t, F.lit(max(x, rules.min_confidence))).otherwise(least)
    entity = text_of(rows, "entity")
    out = [
        ("unknown_variable", ~F.coalesce(known, F.lit(False))),
        ("non_numeric_value", value.isNull()),
        ("non_finite_value", value.isNotNull() & ~finite),
        ("out_of_range", finite & known & ~in_range(F.col("variable_name"), value, rules.bounds)),
        *[(f"missing_{f}", text_of(rows, f, f"{f}_prov") == "") for f in rules.provenance],
        ("missing_entity", entity == ""),
        ("unknown_entity", F.lower(entity) == "unknown"),
    ]
    low = sorted({float(rules.min_confidence), *(max(x, rules.min_confidence) for x in rules.thresholds.values())})
    out += [(f"low_confidence<{x:.2f}", (confidence < least) & (least == x)) for x in low]
    out.append((f"assembled_confidence<{rules.assembled_floor:.2f}", (kind == "assembled") & (confidence < rules.assembled_floor)))
    if {"elements_json", "stoichiometry_json", "spacegroup_symbol", "spacegroup_number"} & set(rows.columns):
        none = lambda c: text_of(rows, c).isin("", "[]")
        out += [("missing_phase_elements", none("elements_json"))] * rules.phase_elements + [("missing_phase_stoichiometry", none("stoichiometry_json"))] * rules.phase_stoichiometry
        out += [("missing_phase_spacegroup", text_of(rows, "spacegroup_symbol", "mp_spacegroup_symbol", "spacegroup_number", "mp_spacegroup_number") == "")] * rules.phase_spacegroup
    if rules.context:
        out += context_checks(rows)
    if rules.reference_mode == "hard":
        out.append(("mp_conflict_hard", reference_conflict(rows)))
    if rules.reference_mode == "hybrid":
        score = F.coalesce(F.col("mp_interpretation_score").cast("double"), F.lit(0.0)) if "mp_interpretation_score" in rows.columns else F.lit(0.0)
        out.append(("mp_conflict_hybrid", reference_conflict(rows) & (F.round(confidence, 9) >= 0.90) & (F.round(score, 9) <= 0.20)))
    return out


def own_reasons(rows: DataFrame, rules: Rules) -> Column:
    """The codes of a row by itself, distinct, sorted and joined by semicolons."""
    return reasons(checks(rows, rules))


def warnings(rows: DataFrame) -> DataFrame:
    """A warning for each row whose reference conflicts, whatever the mode."""
    names = ("mp_status", "mp_interpretation_label", "mp_interpretation_score", "mp_conflict_reason")
    return rows.where(reference_conflict(rows)).select("point_id", F.lit("mp_conflict").alias("reason"), *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names])


def context_reasons(taxonomy: DataFrame) -> DataFrame:
    """The part of a reason table that speaks of context."""
    return taxonomy.where(F.col("reason").rlike(f"(?i){CONTEXT_REASONS}"))


def gate_payload(accepted: DataFrame, calibration_error: float, provenance: tuple[str, ...] = ("citation_url", "snippet", "locator")) -> DataFrame:
    """One row over accepted rows: shares with whole provenance and whole context, and the gates on them; columns that are absent count as blank."""
    whole = lambda names: F.avg(F.when(sum(((text_of(accepted, c) != "").cast("int") for c in names), F.lit(0)) == len(names), 1.0).otherwise(0.0))
    m = accepted.agg(F.count(F.lit(1)).alias("accepted_points"), F.coalesce(whole(provenance), F.lit(0.0)).alias("provenance_complete_ratio"), F.coalesce(whole(CONTEXT_FIELDS), F.lit(0.0)).alias("context_precision_proxy"))
    gates = {"provenance_complete_ratio_eq_1": F.abs(F.col("provenance_complete_ratio") - 1) < 1e-12, "context_precision_ge_0_80": F.round("context_precision_proxy", 9) >= 0.80, "ece_le_0_08": F.lit(calibration_error <= 0.08), "accepted_points_gt_0": F.col("accepted_points") > 0}
    return m.withColumn("ece", F.lit(float(calibration_error))).withColumns(gates).withColumn("all_gates_pass", F.expr(" and ".join(gates)))


def phase_completeness(specs: DataFrame) -> DataFrame:
    """One row: the share of phase specifications with elements, stoichiometry and a space group by symbol or number."""
    whole = filled(F.col("elements_json")) & filled(F.col("stoichiometry_json")) & (text_of(specs, "spacegroup_symbol", "spacegroup_number") != "")
    return specs.agg(F.coalesce(F.avg(whole.cast("double")), F.lit(0.0)).alias("phase_completeness"))
