"""Typed property graphs as node and edge tables, bridges between them, and audits."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions import science
from veinstone.functions.text import blank, json_list, key_clean
from veinstone.operators.context import ontology, ontology_links
from veinstone.operators.validation import text_of
from veinstone.session import looked_up, stored


def node_id(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.concat_ws("|", *[F.lower(F.trim(blank(p.cast("string")))) for p in parts]))


def edge_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, 20))


def nodes(rows: DataFrame, kinds: dict[str, Column], order: str) -> DataFrame:
    """(node_id, node_type, label, n_mentions): values are counted per kind as they come, ids are made of the few that are left; the label is the first by order."""
    made = F.array(*[F.struct(F.lit(k).alias("node_type"), blank(c.cast("string")).alias("label")) for k, c in kinds.items()])
    every = rows.select(F.col(order).alias("_o"), F.explode(made).alias("n")).select("_o", "n.*").where("label <> ''")
    raw = every.groupBy("node_type", "label").agg(F.min("_o").alias("_o"), F.count(F.lit(1)).alias("n"))
    named = raw.withColumn("node_id", F.concat("node_type", F.lit(":"), F.lower(F.trim("label"))))
    return named.groupBy("node_id").agg(F.min("node_type").alias("node_type"), F.min_by("label", F.struct("_o", "label")).alias("label"), F.sum("n").alias("n_mentions"))


def edges(rows: DataFrame, kinds: dict[str, tuple[str, Column, str, Column]]) -> DataFrame:
    """(source_id, target_id, edge_type, weight); kinds: type -> (source kind, column, target kind, column). Edges with a blank end are left out."""
    made = F.array(*[F.when((F.trim(blank(a.cast("string"))) != "") & (F.trim(blank(b.cast("string"))) != ""), F.struct(node_id(s, a).alias("source_id"), node_id(t, b).alias("target_id"), F.lit(k).alias("edge_type"))) for k, (s, a, t, b) in kinds.items()])
    return rows.select(F.explode(F.array_compact(made)).alias("e")).select("e.*").groupBy("source_id", "target_id", "edge_type").agg(F.count(F.lit(1)).alias("weight"))


def bridges(points: DataFrame, concepts: DataFrame, candidates: dict[str, tuple[Column, float]], weight, threshold: float) -> DataFrame:
    """Every candidate link of a point to a concept of its kind and label, with weight and kept. candidates: kind -> (label, proximity); weight: proximity -> column."""
    made = F.array(*[F.struct(F.lit(k).alias("concept_type"), F.lower(F.trim(blank(c.cast("string")))).alias("key"), F.lit(p).alias("proximity")) for k, (c, p) in candidates.items()])
    every = points.withColumn("c", F.explode(made)).select(*points.columns, "c.*").where("key <> ''")
    linked = every.join(concepts, ["concept_type", "key"])
    return linked.withColumn("weight", weight(F.col("proximity"))).withColumn("kept", F.round("weight", 9) >= threshold)


def bridge_stats(links: DataFrame, key: str, n_gates: int) -> DataFrame:
    kept = links.where("kept")
    return kept.groupBy(key).agg(F.count(F.lit(1)).alias("n_bridges"), F.avg("weight").alias("mean_weight"), F.max("weight").alias("max_weight"), (F.countDistinct("concept_type") / n_gates).alias("coverage"))


def audit(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """One row: edges without source or target node, nodes without edge, and the weights' range."""
    ids = node_table.select("node_id")
    ends = edge_table.select(F.col("source_id").alias("node_id")).union(edge_table.select(F.col("target_id").alias("node_id")))
    count = lambda t, name: t.agg(F.count(F.lit(1)).alias(name))
    parts = [
        count(edge_table.join(ids, edge_table["source_id"] == ids["node_id"], "left_anti"), "orphan_sources"),
        count(edge_table.join(ids, edge_table["target_id"] == ids["node_id"], "left_anti"), "orphan_targets"),
        count(ids.join(ends, "node_id", "left_anti"), "isolated_nodes"),
        edge_table.agg(F.count(F.lit(1)).alias("n_edges"), F.min("weight").alias("low"), F.max("weight").alias("high")),
    ]
    return reduce(lambda a, b: a.join(b), parts)  # one row each


def cooccurrence(events: DataFrame, key: str, tokens: dict[str, Column]) -> DataFrame:
    """Unordered pairs of an event's column:value tokens with the number of events. Pairs are made within a row of a fixed number of columns; nulls make no token."""
    made = F.array_sort(F.array_compact(F.array(*[F.concat(F.lit(f"{k}:"), c.cast("string")) for k, c in tokens.items()])))
    t = events.select(made.alias("t"))
    pairs = F.flatten(F.transform("t", lambda a, i: F.transform(F.slice(F.col("t"), i + 2, F.size("t")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return t.select(F.explode(pairs).alias("p")).select("p.a", "p.b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def transitions(rows: DataFrame, by: str, order: list[Column], state: str) -> DataFrame:
    """Counts of changes from one state to the next within a group."""
    w = Window.partitionBy(by).orderBy(*order)
    prev = rows.withColumn("from_state", F.lag(state).over(w)).where(F.col("from_state").isNotNull() & (F.col("from_state") != F.col(state)))
    return prev.groupBy("from_state", F.col(state).alias("to_state")).agg(F.count(F.lit(1)).alias("n"))


def cross_source_support(rows: DataFrame, concept: str, source: str) -> DataFrame:
    return rows.groupBy(concept).agg(F.least(F.lit(1.0), F.countDistinct(source) / 3).alias("support"))


def frequency_features(rows: DataFrame, weights: dict[str, float]) -> DataFrame:
    """rows with the degree of each column's value and their weighted mix over the largest degree: counts per value, joined back, rather than windows over hot values."""
    out = rows
    for c in weights:
        n = rows.groupBy(F.col(c).alias(f"_{c}")).agg(F.count(F.lit(1)).alias(f"{c}_degree"))
        out = out.join(n, out[c].eqNullSafe(n[f"_{c}"])).drop(f"_{c}")
    top = rows.agg(F.count(F.lit(1)).alias("_n"))
    mix = reduce(lambda a, b: a + b, [w * F.col(f"{c}_degree") / F.col("_n") for c, w in weights.items()])
    return out.join(F.broadcast(top)).withColumn("support", mix).drop("_n")  # top: one row


# --- articles' process graph, concepts and bridges between them ----------------------------------

#: Gates of bridges, their proximity, and the weight's threshold.
GATES = {"film": 0.95, "substrate": 0.85, "dopant": 0.85, "method": 0.85, "precursor": 0.75, "thermo": 0.75, "electronic": 0.75}
OTHER_PROXIMITY, THRESHOLD = 0.70, 0.15
#: Agreement of concepts that have no count of sources, and of those that are never counted.
NO_COUNT = 0.3
UNCOUNTED = {"orientation_family": 0.4, "method_family": 0.4, "precursor_chemistry": 0.35, "temperature_regime": 0.35, "stability_band": 0.30, "metallicity_class": 0.30}
#: How well a point agrees with its references, by their label.
ALIGNMENT = {"supports": 1.0, "neutral": 0.6, "conflicts": 0.2, "insufficient": 0.4}


def gate_set(names: list[str] | None) -> set[str]:
    """Gates by name, with or without _gate; all if none of the names is one."""
    return {n.strip().lower().replace("_gate", "") for n in names or []} & set(GATES) or set(GATES)


def number_of(rows: DataFrame, *names: str, default: float = 0.0) -> Column:
    """The first of the columns that exist and hold a finite number."""
    own = [F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x) for n in names if n in rows.columns for x in [F.col(n).try_cast("double")]]
    return F.coalesce(*own, F.lit(default))


def prepared(points: DataFrame) -> DataFrame:
    """points as the graphs read them: absent and blank columns by their defaults, formula and signatures made."""
    t = lambda other, *names: F.coalesce(F.nullif(text_of(points, *names), F.lit("")), F.lit(other))
    signature = lambda kind, other: F.coalesce(F.nullif(F.array_join(F.array_sort(json_list(F.col(f"{kind}_elements"))), "+"), F.lit("")) if f"{kind}_elements" in points.columns else F.lit(None).cast("string"), F.nullif(text_of(points, f"{kind}_state"), F.lit("")), F.lit(other))
    lists = lambda kind: json_list(F.col(f"{kind}_elements")) if f"{kind}_elements" in points.columns else F.array().cast("array<string>")
    hull, confidence = number_of(points, "mp_energy_above_hull_min", default=-1.0), number_of(points, "confidence", default=0.9)
    return points.select(
        t("unknown_article", "article_key").alias("article_key"), text_of(points, "point_id").alias("point_id"), t("unknown_phase", "phase_label", "entity").alias("phase"), t("unknown_phase", "film_material", "phase_label", "entity").alias("film"),
        science.reduced_formula(text_of(points, "film_material", "phase_label", "entity")).alias("formula"), t("unknown_substrate", "substrate_material").alias("substrate"), t("unknown_orientation", "substrate_orientation").alias("orientation"),
        t("unknown_method", "method_family").alias("method"), t("unknown_precursor", "precursor").alias("precursor"), t("unknown_ambient", "ambient").alias("ambient"), signature("doping", "undoped").alias("dopant_signature"), signature("alloy", "unalloyed").alias("alloy_signature"),
        lists("doping").alias("dopants"), lists("alloy").alias("alloys"), confidence.alias("confidence"), F.concat_ws("|", text_of(points, "citation_url"), text_of(points, "locator")).alias("provenance_ref"),
        *[number_of(points, c).alias(c) for c in ("thickness_nm", "pressure_pa", "composition_value", "vacancy_concentration_cm3", "deposition_temperature_c", "deposition_rate_nm_s", "anneal_time_s", "anneal_rate_c_s", "film_quality_score_numeric")],
        number_of(points, "anneal_temperature_c", "temperature_c").alias("anneal_temperature_c"), number_of(points, "anneal_temperature_c").alias("regime_temperature_c"), hull.alias("hull"), number_of(points, "band_gap", default=-1.0).alias("band_gap"),
        text_of(points, "is_metal").alias("is_metal"), text_of(points, "magnetic_ordering").alias("magnetic"), science.spacegroup_symbol(text_of(points, "spacegroup_symbol", "mp_spacegroup_symbol")).alias("sg_symbol"), science.spacegroup_number(text_of(points, "spacegroup_number", "mp_spacegroup_number")).alias("sg_number"),
        text_of(points, "interface_quality_label").alias("interface"), text_of(points, "prototype_family").alias("prototype"), F.lower(text_of(points, "mp_interpretation_label")).alias("mp_label"),
        (sum(((text_of(points, c) != "").cast("int") for c in ("citation_url", "snippet", "locator")), F.lit(0)) / 3.0).alias("provenance_quality"),
    )


def json_numbers(fields: dict[str, Column]) -> Column:
    """A JSON object of numbers, and texts, by sorted name."""
    parts = [x for k, c in sorted(fields.items()) for x in (F.lit(f'"{k}": '), c, F.lit(", "))][:-1]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def _own_id(kind: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col("article_key"), F.lit(":"), F.col("point_id"))


def _conditions() -> dict[str, Column]:
    text = lambda c: F.col(c).cast("string")
    deposition = {"deposition_thickness_nm": text("thickness_nm"), "deposition_pressure_pa": text("pressure_pa"), "deposition_composition_value": text("composition_value"), "deposition_vacancy_concentration_cm3": text("vacancy_concentration_cm3"), "deposition_temperature_c": text("deposition_temperature_c"), "deposition_rate_nm_s": text("deposition_rate_nm_s")}
    anneal = {"anneal_temperature_c": text("anneal_temperature_c"), "anneal_time_s": text("anneal_time_s"), "anneal_rate_c_s": text("anneal_rate_c_s"), "anneal_pressure_pa": text("pressure_pa"), "anneal_ambient": F.concat(F.lit('"'), F.col("ambient"), F.lit('"'))}
    made = lambda fields: F.substring(F.sha1(F.concat_ws("|", "article_key", "point_id", json_numbers(fields)).cast("binary")), 1, 16)
    return {"condition_vector_deposition": made(deposition), "condition_vector_anneal": made(anneal)}


#: Nodes that articles share: type -> (column, stage). Ids are the type and the clean label, of articles the label.
SHARED = {
    "article": ("article_key", "deposition"), "substrate": ("substrate", "deposition"), "substrate_orientation": ("orientation", "deposition"), "dopant_signature": ("dopant_signature", "deposition"), "alloy_signature": ("alloy_signature", "deposition"),
    "precursor": ("precursor", "deposition"), "method_step_deposition": ("method", "deposition"), "method_step_anneal": ("method", "annealing"),
}
#: Nodes of one point: type -> stage.
OWN = {
    "deposition_state": "deposition", "anneal_step": "annealing", "film_phase_instance_as_deposited": "deposition", "film_phase_instance_post_anneal": "annealing",
    "condition_vector_deposition": "deposition", "condition_vector_anneal": "annealing", "quality_outcome": "annealing",
}
#: Edges of a point: (source type, target type, edge type).
PROCESS_EDGES = (
    ("article", "deposition_state", "article_has_deposition_state"), ("deposition_state", "anneal_step", "deposition_state_precedes_anneal_step"), ("deposition_state", "film_phase_instance_as_deposited", "deposition_state_yields_phase_instance"),
    ("anneal_step", "film_phase_instance_post_anneal", "anneal_step_yields_phase_instance"), ("film_phase_instance_as_deposited", "film_phase_instance_post_anneal", "phase_instance_transitions_to_phase_instance"),
    ("film_phase_instance_as_deposited", "condition_vector_deposition", "phase_instance_observed_under_condition"), ("film_phase_instance_post_anneal", "condition_vector_anneal", "phase_instance_observed_under_condition"),
    ("film_phase_instance_post_anneal", "quality_outcome", "phase_instance_has_quality_outcome"), ("deposition_state", "substrate", "deposition_state_on_substrate"), ("deposition_state", "substrate_orientation", "deposition_state_has_orientation"),
    ("deposition_state", "dopant_signature", "deposition_state_has_dopant_signature"), ("deposition_state", "alloy_signature", "deposition_state_has_alloy_signature"), ("deposition_state", "precursor", "deposition_state_uses_precursor"),
    ("deposition_state", "method_step_deposition", "deposition_state_uses_method_step"), ("anneal_step", "method_step_anneal", "anneal_step_uses_method_step"),
)


def _process_ids() -> dict[str, Column]:
    shared = {k: F.concat(F.lit(f"{k}:"), F.col(c) if k == "article" else key_clean(F.col(c))) for k, (c, _) in SHARED.items()}
    conditions = {k: F.concat(F.lit(f"{k}:"), c) for k, c in _conditions().items()}
    return shared | {k: conditions.get(k, _own_id(k)) for k in OWN}


def _shared_nodes(p: DataFrame) -> DataFrame:
    shared = F.array(*[F.struct(F.lit(k).alias("node_type"), F.lit(stage).alias("stage"), F.col(c).alias("label")) for k, (c, stage) in SHARED.items()])
    raw = p.select("article_key", F.explode(shared).alias("n")).select("article_key", "n.*").groupBy("node_type", "stage", "label").agg(F.min("article_key").alias("article_key"))
    named = raw.withColumn("node_id", F.concat("node_type", F.lit(":"), F.when(F.col("node_type") == "article", F.col("label")).otherwise(key_clean(F.col("label")))))
    return named.groupBy("node_id", "node_type", "stage").agg(F.min(F.struct("article_key", "label")).alias("f")).select("node_id", "node_type", "f.article_key", "stage", "f.label")


def process_graph(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of points, one a row with a point_id of its own: deposition, annealing, phases, conditions and outcome of each, and what articles share.

    Nodes of points are made row by row; only what is shared is aggregated, by its raw label.
    """
    p, ids = prepared(points).where("point_id <> ''"), _process_ids()
    labels = {"film_phase_instance_as_deposited": F.col("film"), "film_phase_instance_post_anneal": F.col("phase"), "quality_outcome": F.lit("quality_outcome"), "deposition_state": F.concat(F.lit("deposition:"), "point_id"), "anneal_step": F.concat(F.lit("anneal:"), "point_id")}
    own = F.array(*[F.struct(ids[k].alias("node_id"), F.lit(k).alias("node_type"), F.lit(stage).alias("stage"), labels.get(k, ids[k]).alias("label")) for k, stage in OWN.items()])
    of_points = p.select("article_key", F.explode(own).alias("n")).select("n.node_id", "n.node_type", "article_key", "n.stage", "n.label")
    of_all = _shared_nodes(p)
    made = F.array(*[F.struct(ids[s].alias("source_id"), ids[t].alias("target_id"), F.lit(k).alias("edge_type")) for s, t, k in PROCESS_EDGES])
    links = p.select("article_key", "point_id", "confidence", "provenance_ref", F.explode(made).alias("e")).select("article_key", "e.*", science.clamp(F.col("confidence")).alias("evidence_weight"), "provenance_ref", F.col("point_id").alias("source_point_id"))
    return of_points.unionByName(of_all), links.withColumn("edge_id", edge_id("edge_", F.col("article_key"), F.col("source_id"), F.col("target_id"), F.col("edge_type"), F.col("source_point_id")))


def _ratio(x: Column) -> Column:
    return F.format_string("%s:%.4f", x["element"], F.when(x["ratio"] > 0, x["ratio"]).otherwise(1.0))


def _concepts_of_points() -> Column:
    one = lambda kind, label: F.struct(F.lit(kind).alias("concept_type"), label.alias("label"))
    many = lambda kind, labels: F.transform(labels, lambda x: one(kind, x))
    or_ = lambda c, other: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(other))
    group = F.when(F.col("sg_symbol") != "", F.col("sg_symbol")).otherwise(F.concat(F.lit("sg"), F.col("sg_number")))
    has_group = (F.col("sg_symbol") != "") | (F.col("sg_number") != "")
    fixed = F.array(
        one("formula", or_("formula", "unknown_formula")), one("substrate_material", F.col("substrate")), one("orientation_family", F.col("orientation")), one("precursor_chemistry", F.col("precursor")), one("method_family", F.col("method")), one("ambient_gas", F.col("ambient")),
        one("temperature_regime", science.bucket(F.col("regime_temperature_c"), science.TEMPERATURE)), one("time_regime", science.bucket(F.col("anneal_time_s"), science.TIME)), one("pressure_regime", science.bucket(F.col("pressure_pa"), science.PRESSURE)),
        one("stability_band", science.bucket(F.col("hull"), science.STABILITY)), one("energy_hull_bucket", science.bucket(F.col("hull"), science.HULL)), one("bandgap_bucket", science.bandgap_bucket(F.col("band_gap"))), one("metallicity_class", science.metallicity(F.col("is_metal"))),
        one("magnetic_class", or_("magnetic", "magnetic_unknown")), one("quality_metric_type", F.lit("film_quality_score_numeric")), one("defect_metric_type", F.when(F.col("vacancy_concentration_cm3") > 0, "vacancy_concentration_cm3").otherwise("defect_unknown")),
        one("interface_state_type", or_("interface", "interface_unknown")), one("prototype_family", or_("prototype", "prototype_unknown")),
    )
    groups = F.when(has_group, F.array(one("space_group", group), one("crystal_system", science.crystal_system(F.col("sg_number").try_cast("int"))))).otherwise(F.array().cast("array<struct<concept_type: string, label: string>>"))
    return F.concat(fixed, many("element", science.elements(F.col("formula"))), F.transform(science.stoichiometry(F.col("formula")), lambda x: one("stoich_component", _ratio(x))), many("dopant_element", F.col("dopants")), many("alloy_element", F.col("alloys")), groups)


def concept_graph(points: DataFrame, seeded: bool = True) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the concepts that points name, each once: (concept_id, concept_type, key, label), seeds first, and (source_id, target_id, edge_type, evidence_weight), of equal edges the one of the least point."""
    spark, p = points.sparkSession, prepared(points)
    seen = p.select(F.explode(_concepts_of_points()).alias("c")).select("c.*").groupBy("concept_type", "label").agg(F.count(F.lit(1)).alias("n"))
    own = seen.select("concept_type", key_clean(F.col("label")).alias("key"), "label", F.lit(1).alias("rank"))
    every = own.union(ontology(spark).select("concept_type", "key", "label", F.lit(0).alias("rank"))) if seeded else own
    concept = lambda kind, key: F.concat(F.lit("concept:"), kind, F.lit(":"), key)
    nodes_ = every.groupBy("concept_type", "key").agg(F.min(F.struct("rank", "label")).alias("f")).select(concept(F.col("concept_type"), F.col("key")).alias("concept_id"), "concept_type", "key", F.col("f.label").alias("label"))
    link = lambda s, sk, t, tk, k, w: F.struct(concept(F.lit(s), key_clean(sk)).alias("source_id"), concept(F.lit(t), key_clean(tk)).alias("target_id"), F.lit(k).alias("edge_type"), w.alias("weight"))
    formula, w = F.coalesce(F.nullif(F.col("formula"), F.lit("")), F.lit("unknown_formula")), science.clamp(F.col("confidence"))
    group = F.when(F.col("sg_symbol") != "", F.col("sg_symbol")).otherwise(F.concat(F.lit("sg"), F.col("sg_number")))
    groups = F.array(link("formula", formula, "space_group", group, "formula_has_space_group", w), link("space_group", group, "crystal_system", science.crystal_system(F.col("sg_number").try_cast("int")), "space_group_in_crystal_system", F.lit(0.8)))
    made = F.concat(
        F.array(link("substrate_material", F.col("substrate"), "orientation_family", F.col("orientation"), "substrate_has_orientation_family", w)),
        F.transform(science.elements(F.col("formula")), lambda e: link("formula", formula, "element", e, "formula_has_element", w)),
        F.transform(science.stoichiometry(F.col("formula")), lambda x: link("formula", formula, "stoich_component", _ratio(x), "formula_has_stoich_component", w)),
        F.when((F.col("sg_symbol") != "") | (F.col("sg_number") != ""), groups).otherwise(F.array().cast("array<struct<source_id: string, target_id: string, edge_type: string, weight: double>>")),
    )
    found = p.select("point_id", F.explode(made).alias("e")).select("e.source_id", "e.target_id", "e.edge_type", F.col("e.weight").alias("weight"), F.struct(F.lit(1).alias("a"), "point_id").alias("o"))
    seeds = ontology_links(spark).select(concept(F.col("source_type"), F.col("source_key")).alias("source_id"), concept(F.col("target_type"), F.col("target_key")).alias("target_id"), "edge_type", "weight", F.struct(F.lit(0).alias("a"), F.lit("").alias("point_id")).alias("o"))
    edges_ = (found.union(seeds) if seeded else found).groupBy("source_id", "target_id", "edge_type").agg(F.min_by("weight", "o").alias("evidence_weight"))
    return nodes_, edges_.withColumn("edge_id", edge_id("edge_", F.col("source_id"), F.col("target_id"), F.col("edge_type")))


def concept_support(points: DataFrame) -> DataFrame:
    """(concept_type, key, support): distinct articles of each formula, element and substrate over three, at most 1."""
    p = prepared(points)
    one = lambda kind, label: F.struct(F.lit(kind).alias("concept_type"), key_clean(label).alias("key"))
    named = lambda c: F.when(c, F.lit(True))
    made = F.concat(F.array_compact(F.array(F.when(named(F.col("formula") != ""), one("formula", F.col("formula"))), F.when(named(F.col("substrate") != "unknown_substrate"), one("substrate_material", F.col("substrate"))))), F.transform(science.elements(F.col("formula")), lambda e: one("element", e)))
    return p.select("article_key", F.explode(made).alias("c")).select("article_key", "c.*").groupBy("concept_type", "key").agg(F.least(F.lit(1.0), F.countDistinct("article_key") / 3).alias("support"))


def _linkable(points: DataFrame, concepts: DataFrame) -> DataFrame:
    """What links join: (concept_type, key, target_id, support) of concepts, support null where it is not counted."""
    return concepts.select("concept_type", "key", F.col("concept_id").alias("target_id")).join(concept_support(points), ["concept_type", "key"], "left")


def bridge_candidates(points: DataFrame, concepts: DataFrame, gates: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Every link of a point to a concept that exists, with gate, weight and keep: the gate is allowed and the weight reaches the threshold."""
    linked = _linked(prepared(points).where("point_id <> ''"), looked_up(_linkable(points, concepts), "linkable"), gates, threshold)
    return linked.select("article_key", "source_id", "target_id", "gate_type", "keep", "weight", "provenance_ref", "source_point_id")


def _linked(p: DataFrame, linkable: DataFrame, gates: list[str] | None, threshold: float) -> DataFrame:
    """The links of prepared points to what is linkable, whose columns stay."""
    phase, deposition, anneal = _own_id("film_phase_instance_post_anneal"), _own_id("deposition_state"), _own_id("anneal_step")
    one = lambda source, kind, label, gate: F.struct(source.alias("source_id"), F.lit(kind).alias("concept_type"), key_clean(label).alias("key"), F.lit(gate).alias("gate"))
    metal = F.when(science.metallicity(F.col("is_metal")) == "metallic", "metallic").otherwise("metallicity_unknown")
    fixed = F.array(
        one(phase, "formula", F.coalesce(F.nullif(F.col("formula"), F.lit("")), F.lit("unknown_formula")), "film"), one(deposition, "substrate_material", F.col("substrate"), "substrate"), one(deposition, "orientation_family", F.col("orientation"), "substrate"),
        one(deposition, "precursor_chemistry", F.col("precursor"), "precursor"), one(deposition, "method_family", F.col("method"), "method"), one(anneal, "temperature_regime", science.bucket(F.col("regime_temperature_c"), science.TEMPERATURE), "method"),
        one(phase, "stability_band", science.bucket(F.col("hull"), science.STABILITY), "thermo"), one(phase, "metallicity_class", metal, "electronic"),
    )
    alignment = reduce(lambda w, kv: w.when(F.col("mp_label") == kv[0], F.lit(kv[1])), ALIGNMENT.items(), F.when(F.lit(False), F.lit(0.0))).otherwise(0.5)
    made = F.concat(fixed, F.transform(science.elements(F.col("formula")), lambda e: one(phase, "element", e, "film")))
    every = p.select("article_key", F.col("point_id").alias("source_point_id"), "provenance_ref", science.clamp(F.col("confidence")).alias("extraction_conf"), "provenance_quality", alignment.alias("mp_alignment"), *[c for c in ("own_sources",) if c in p.columns], F.explode(made).alias("c")).select("*", "c.*").drop("c")
    linked = every.join(linkable, ["concept_type", "key"])
    fixed_agreement = reduce(lambda w, kv: w.when(F.col("concept_type") == kv[0], F.lit(kv[1])), UNCOUNTED.items(), F.when(F.lit(False), F.lit(0.0))).otherwise(F.coalesce("support", F.lit(NO_COUNT)))
    proximity = reduce(lambda w, kv: w.when(F.col("gate") == kv[0], F.lit(kv[1])), GATES.items(), F.when(F.lit(False), F.lit(0.0))).otherwise(OTHER_PROXIMITY)
    weight = science.bridge_weight(F.col("extraction_conf"), F.col("provenance_quality"), proximity, fixed_agreement, F.col("mp_alignment"))
    out = linked.withColumns({"weight": weight, "gate_type": F.concat("gate", F.lit("_gate"))})
    return out.withColumn("keep", F.col("gate").isin(*sorted(gate_set(gates))) & (F.round("weight", 9) >= threshold))


def _bridge_id() -> Column:
    return edge_id("bridge_", F.col("article_key"), F.col("source_id"), F.col("target_id"), F.col("gate_type"), F.col("source_point_id"))


def bridge_edges(candidates: DataFrame) -> DataFrame:
    return candidates.where("keep").withColumn("bridge_id", _bridge_id()).drop("keep").dropDuplicates(["bridge_id"])


def bridge_features(rows: DataFrame, bridges_: DataFrame, key: str = "point_id") -> DataFrame:
    """rows with count, mean, largest weight and share of the seven gates of their bridges; 0 without any."""
    stats = bridges_.groupBy(F.col("source_point_id").alias("_p")).agg(F.count(F.lit(1)).cast("double").alias("concept_bridge_count"), F.avg("weight").alias("concept_bridge_mean_weight"), F.max("weight").alias("concept_bridge_max_weight"), (F.countDistinct("gate_type") / 7).alias("concept_gate_coverage"))
    names = [c for c in stats.columns if c != "_p"]
    out = rows.drop(*names).join(stats, F.col(key) == F.col("_p"), "left").drop("_p")
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in names})


def dual_audit(process: tuple[DataFrame, DataFrame], concepts: tuple[DataFrame, DataFrame], candidates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row: orphans of the three edge tables, weights out of range or under the threshold, precedence edges between wrong types, and ok."""
    ids, links = process[0].select(F.col("node_id").alias("id"), "node_type"), process[1].select("source_id", "target_id", "edge_type")
    notions = concepts[0].select(F.col("concept_id").alias("id"))
    lost = lambda e, end, nodes_: e.join(nodes_.select("id"), e[end] == nodes_["id"], "left_anti").agg(F.count(F.lit(1)).alias("n"))
    kept = bridge_edges(candidates)
    counts = {
        "process_orphans": [lost(links, "source_id", ids), lost(links, "target_id", ids)], "concept_orphans": [lost(concepts[1], "source_id", notions), lost(concepts[1], "target_id", notions)], "bridge_orphans": [lost(kept, "source_id", ids), lost(kept, "target_id", notions)],
        "bad_weights": [candidates.agg(F.count_if(~F.col("weight").between(0, 1) | (F.col("keep") & (F.round("weight", 9) < threshold))).alias("n"))],
        "bad_precedence": [lost(links.where("edge_type = 'deposition_state_precedes_anneal_step'"), "source_id", ids.where("node_type = 'deposition_state'")), lost(links.where("edge_type = 'deposition_state_precedes_anneal_step'"), "target_id", ids.where("node_type = 'anneal_step'"))],
    }
    rows = [t.select(F.lit(name).alias("issue"), "n") for name, ts in counts.items() for t in ts]
    long = reduce(DataFrame.unionByName, rows)  # a row each
    wide = long.agg(*[F.sum(F.when(F.col("issue") == name, F.col("n")).otherwise(0)).alias(name) for name in counts])
    return wide.withColumn("ok", F.expr(" + ".join(counts)) == 0)


def _stem(node: Column) -> Column:
    """One of 4,096 numbers of an id's part before the first colon: ids that differ in it are not equal."""
    return F.pmod(F.xxhash64(F.substring_index(node, ":", 1)), F.lit(4096)).cast("int")


def dual_audit_of(points: DataFrame, lacking: set[str] = frozenset(), lacking_concepts: set[str] = frozenset(), threshold: float = THRESHOLD) -> DataFrame:
    """dual_audit of the graphs of points that lack nodes and concepts of some types, without tables of all nodes and edges.

    An end of an edge is looked for among its own point's nodes, then among the nodes that points share, and only then,
    if the stems of ids allow a match at all, among all points' nodes. Of bridges, only those that lack an end are told apart by id.
    """
    spark, p, ids = points.sparkSession, prepared(points).where("point_id <> ''"), _process_ids()
    own, precedes = [k for k in OWN if k not in lacking], "deposition_state_precedes_anneal_step"
    rows = p.select(*[ids[k].alias(k) for k in ids]).withColumn("own", F.array(*own).cast("array<string>"))
    # (issue, kind of the end, type that it must have, number of the point's edges with that end)
    asked = [("process_orphans", k, "", n) for k, n in Counter(end for s, t, _ in PROCESS_EDGES for end in (s, t)).items()]
    asked += [("bad_precedence", end, need, 1) for s, t, k in PROCESS_EDGES if k == precedes for end, need in ((s, "deposition_state"), (t, "anneal_step"))]
    here = lambda end, need: F.coalesce(F.array_contains("own", end) if not need else end == F.col(need) if need in own else F.lit(False), F.lit(False))
    lost = F.array_compact(F.array(*[F.when(~here(F.col(k), need), F.struct(F.lit(issue).alias("issue"), F.col(k).alias("id"), F.lit(need).alias("need"), F.lit(n).alias("n"))) for issue, k, need, n in asked]))
    ends = rows.select(F.explode(lost).alias("e")).select("e.*")

    def needs(nodes_: DataFrame) -> DataFrame:
        """(id, need) of nodes: each answers for any type and for its own."""
        return nodes_.select("id", F.explode(F.array(F.lit(""), "node_type")).alias("need")).distinct()

    notions = concept_graph(points)
    named, concept_links = stored(notions[0].select("concept_id", "concept_type", "key"), "concepts"), stored(notions[1].select("source_id", "target_id"), "concept-edges")
    there = (named.where(~F.col("concept_type").isin(*lacking_concepts)) if lacking_concepts else named).select(F.col("concept_id").alias("target_id")).distinct()
    linkable = looked_up(_linkable(points, named).join(there.withColumn("there", F.lit(True)), "target_id", "left"), "linkable")
    # the sources of links are nodes of their point: of these three types
    sources = F.array(*[_own_id(k) for k in ("film_phase_instance_post_anneal", "deposition_state", "anneal_step") if k not in lacking]).cast("array<string>")
    linked = _linked(p.withColumn("own_sources", sources), linkable, None, threshold)
    no_source, no_target = ~F.coalesce(F.array_contains("own_sources", F.col("source_id")), F.lit(False)), F.col("there").isNull()
    weights = linked.agg(F.count_if(~F.col("weight").between(0, 1) | (F.col("keep") & (F.round("weight", 9) < threshold))), F.count_if(F.col("keep") & no_source), F.count_if(F.col("keep") & no_target)).first()
    told = lambda lack: linked.where(F.col("keep") & lack).select(F.unhex(F.substring_index(_bridge_id(), "_", -1)).alias("bridge_id"), F.col("source_id").alias("id"))
    counts = Counter(bad_weights=weights[0], bridge_orphans=told(no_target).select("bridge_id").distinct().count() if weights[2] else 0)
    if weights[1]:
        ends = ends.union(told(no_source).distinct().select(F.lit("bridge_orphans"), "id", F.lit(""), F.lit(1)))
    of_all = _shared_nodes(p).select(F.col("node_id").alias("id"), "node_type")
    shared = looked_up(needs(of_all.where(~F.col("node_type").isin(*lacking)) if lacking else of_all), "shared")
    left = ends.join(shared, ["id", "need"], "left_anti")
    found = left.groupBy("issue", _stem(F.col("id")).alias("stem")).agg(F.sum("n").alias("n")).collect()
    every = rows.select(F.explode(F.array(*[F.struct(F.col(k).alias("id"), F.lit(k).alias("node_type")) for k in own])).alias("e")).select("e.*") if own else None
    common = sorted({r["stem"] for r in every.select(_stem(F.col("id")).alias("stem")).distinct().collect()} & {r["stem"] for r in found}) if own and found else []
    for r in found:
        counts[r["issue"]] += r["n"] if r["stem"] not in common else 0
    if common:
        some = lambda t: t.where(_stem(F.col("id")).isin(*common))
        counts.update({r["issue"]: r["n"] for r in some(left).join(needs(some(every)), ["id", "need"], "left_anti").groupBy("issue").agg(F.sum("n").alias("n")).collect()})
    for end in ("source_id", "target_id"):
        counts["concept_orphans"] += concept_links.join(there, concept_links[end] == there["target_id"], "left_anti").count()
    names = ("process_orphans", "concept_orphans", "bridge_orphans", "bad_weights", "bad_precedence")
    return spark.createDataFrame([(*[counts[x] for x in names], sum(counts[x] for x in names) == 0)], ", ".join(f"{x} long" for x in names) + ", ok boolean")
