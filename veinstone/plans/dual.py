"""Queries of validation, materials, dual graphs, recipes, benchmarks and training rows. Points are line items with their part and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinstone.operators import graphs, joins, knowledge, materials, recipes, training, validation
from veinstone.plans.evidence import lines, point_key, read
from veinstone.plans.relations import gold_and_pred
from veinstone.session import looked_up

FORMULAS = ("NiSi", "Ni2Si", "NiSi2", "CoSi2", "unknown")


def pick(values, by):
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(by, F.lit(len(values))).cast("int"))


def duck(values, by):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][({by}) % {len(values)} + 1]"


# --- validation ----------------------------------------------------------------------------------

RULES = validation.Rules({"x": (3, 45), "y": (None, 40)}, {"f": 0.95}, 0.92, ("citation_url", "locator"), 0.97, True, True, False, True, "hybrid")


def evidence(spark, sf_dir):
    n = F.col("l_linenumber")
    return lines(spark, sf_dir).select(
        point_key().alias("point_id"), F.when(n % 3 == 0, "x").when(n % 3 == 1, "y").otherwise("z").alias("variable_name"), F.when(n == 7, float("nan")).otherwise(F.col("l_quantity")).alias("normalized_value"), (1 - F.col("l_discount")).alias("confidence"),
        F.when(n == 5, "assembled").otherwise(F.lower("l_linestatus")).alias("extraction_type"), F.when(n == 1, "").when(n == 2, "Unknown").otherwise(F.col("l_returnflag")).alias("entity"), F.lit("u").alias("citation_url"), F.when(n == 4, " ").otherwise("line:1").alias("locator"),
        F.when(n % 2 == 0, '["Ni"]').otherwise("[]").alias("elements_json"), F.when(n == 3, "62").alias("spacegroup_number"), F.when(n < 6, "Si").alias("substrate_material"), F.when(n > 2, "(100)").otherwise("").alias("substrate_orientation"),
        pick(("doped", "undoped", "na_pure_ni", ""), n).alias("doping_state"), pick(("pure", "other", "na_pure_ni"), n).alias("alloy_state"), (n % 4 == 0).alias("pure_ni_evidence"), pick(("[]", "no json", '{"a": 1}', ""), n).alias("doping_composition"),
        F.when(F.col("l_tax") > 0.06, "conflicts").otherwise("supports").alias("mp_interpretation_label"), F.col("l_tax").alias("mp_interpretation_score"),
    )


def row_reasons(spark, sf_dir):
    rows = evidence(spark, sf_dir)
    return rows.select("point_id", validation.own_reasons(rows, RULES).alias("reasons"))


REASONS = """r as (select concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice::decimal(18,2)) as point_id, l_linenumber as n, l_quantity as v, round(1 - l_discount, 9) as c, l_linestatus as s, l_tax as t from lineitem),
w as (select *, list_sort(list_filter([case when n % 3 = 2 then 'unknown_variable' end, case when n = 7 then 'non_finite_value' end, case when n <> 7 and ((n % 3 = 0 and v not between 3 and 45) or (n % 3 = 1 and v > 40)) then 'out_of_range' end,
  case when n = 4 then 'missing_locator' end, case when n = 1 then 'missing_entity' end, case when n = 2 then 'unknown_entity' end, case when n <> 5 and s = 'F' and c < 0.95 then 'low_confidence<0.95' end, case when (n = 5 or s <> 'F') and c < 0.92 then 'low_confidence<0.92' end,
  case when n = 5 and c < 0.97 then 'assembled_confidence<0.97' end, case when n % 2 = 1 then 'missing_phase_elements' end, case when n <> 3 then 'missing_phase_spacegroup' end, case when n >= 6 then 'missing_substrate' end, case when n <= 2 then 'missing_orientation' end,
  case when n % 4 = 3 then 'missing_doping_context' end, case when n % 3 = 1 then 'missing_alloy_context' end, case when (n % 4 = 2 or n % 3 = 2) and n % 4 <> 0 then 'pure_ni_exception_not_supported_by_evidence' end, case when n % 4 in (1, 2) then 'invalid_composition_format' end,
  case when t > 0.06 and c >= 0.90 and t <= 0.20 then 'mp_conflict_hybrid' end], lambda x: x is not null)) as codes from r)"""


def context_taxonomy(spark, sf_dir):
    rows = evidence(spark, sf_dir)
    long = rows.select(F.explode(F.split(validation.own_reasons(rows, RULES), ";")).alias("reason")).where("reason <> ''").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return validation.context_reasons(long)


def conflict_warnings(spark, sf_dir):
    return validation.warnings(evidence(spark, sf_dir)).groupBy("reason", "mp_interpretation_label").agg(F.count(F.lit(1)).alias("n"))


def gate_payload(spark, sf_dir):
    out = validation.gate_payload(evidence(spark, sf_dir), 0.05, ("citation_url", "locator"))
    return out.withColumns({c: F.round(c, 6) for c in ("provenance_complete_ratio", "context_precision_proxy")})


PAYLOAD_SQL = """with r as (select l_linenumber as n from lineitem),
m as (select count(*) as accepted_points, avg((n <> 4)::int) as p, avg((n < 6 and n > 2 and n % 4 <> 3)::int) as c from r)
select accepted_points, round(p, 6) as provenance_complete_ratio, round(c, 6) as context_precision_proxy, 0.05::double as ece, abs(p - 1) < 1e-12 as provenance_complete_ratio_eq_1, round(c, 9) >= 0.8 as context_precision_ge_0_80, true as ece_le_0_08, accepted_points > 0 as accepted_points_gt_0,
  abs(p - 1) < 1e-12 and round(c, 9) >= 0.8 and accepted_points > 0 as all_gates_pass from m"""


# --- materials -----------------------------------------------------------------------------------


def material_points(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(F.col("p_partkey").cast("string").alias("point_id"), pick(("Ni 2 Si", "monosilicide film", "unknown", "none", "Xy2"), k).alias("entity"), pick(("the Co 3 Si phase", "beta", "a NiSi2 layer"), k).alias("snippet"), pick(("doped", ""), k).alias("doping_state"), pick(('["Pt", "Au"]', "['Pt']", ""), k).alias("doping_elements"))


def material_identity(spark, sf_dir):
    return materials.identities(material_points(spark, sf_dir), {"monosilicide": "NiSi"}).select("point_id", "formula", "phase_target_value", "doping_signature", "query_key")


IDENTITY = """p as (select p_partkey as k, ['Ni 2 Si', 'monosilicide film', 'unknown', 'none', 'Xy2'][p_partkey % 5 + 1] as e, [['Co3Si'], [], ['NiSi2']][p_partkey % 3 + 1] as tokens from part),
f as (select *, case k % 5 when 0 then 'Ni2Si' when 1 then 'NiSi' else coalesce(tokens[1], '') end as formula from p),
i as (select k::varchar as point_id, formula, case when formula <> '' then formula else e end as phase_target_value, concat_ws('|', case when k % 2 = 0 then 'doping_state:doped' end, case when k % 3 = 0 then 'doping_elements:Au,Pt' end) as doping_signature from f)"""
IDENTITY_SQL = f"with {IDENTITY} select *, sha1(formula || '|phase_label|' || phase_target_value || '|' || doping_signature || '|summary_thermo') as query_key from i"


def references(spark):
    return spark.createDataFrame([("m1", "NiSi", 0.0), ("m2", "Ni2Si", 0.07), ("m3", "CoSi2", 0.2), ("m4", "PtO", None)], "material_id string, formula_pretty string, energy_above_hull double")


def material_interpretation(spark, sf_dir):
    """Every identity against a service's references, by query key."""
    own = materials.identities(material_points(spark, sf_dir), {"monosilicide": "NiSi"})
    keys = own.where("formula <> ''").select("query_key").distinct()
    refs = keys.join(F.broadcast(references(spark)))  # four references
    return materials.interpreted(own, refs).select("point_id", "mp_best_material_id", "mp_references", F.round("mp_interpretation_score", 6).alias("score"), "mp_interpretation_label", "mp_conflict_reason")


INTERPRETATION_SQL = f"""with {IDENTITY}, r(m, ref, hull, el) as (values ('m1', 'NiSi', 0.0, ['Ni', 'Si']), ('m2', 'Ni2Si', 0.07, ['Ni', 'Si']), ('m3', 'CoSi2', 0.2, ['Co', 'Si']), ('m4', 'PtO', null, ['O', 'Pt'])),
x as (select *, list_sort(list_distinct(regexp_extract_all(formula, '[A-Z][a-z]?'))) as own from i),
s as (select *, case when formula = ref then 1 when own = el then 0.85 when list_has_any(own, el) then 0.55 else 0 end::double as f, case when hull is null then 0 when hull <= 0.05 then 1 when hull <= 0.10 then 0.7 else 0.4 end as st from x left join r on formula <> ''),
t as (select *, case when m is null then 0 else 0.5 * f + 0.3 * case when f = 1 then 1 when f > 0 then 0.6 else 0 end + 0.2 * st end as score from s),
b as (select point_id, arg_min({{'m': m, 's': score, 'f': f}}, {{'a': -round(score, 9), 'b': -f, 'c': m}}) as b, count(m) as n from t group by 1)
select point_id, b.m as mp_best_material_id, n as mp_references, round(b.s, 6)::double as score, case when n = 0 then 'insufficient' when round(b.s, 9) >= 0.70 then 'supports' when round(b.s, 9) <= 0.35 and b.f < 0.40 then 'conflicts' else 'neutral' end as mp_interpretation_label,
  case when n > 0 and round(b.s, 9) <= 0.35 and b.f < 0.40 then 'formula_mismatch' else '' end as mp_conflict_reason from b"""


def service(url: str, parameters: dict, key: str) -> tuple[int, str]:
    """A reference service that knows one material of each formula, and fails for some."""
    if parameters.get("formula") == "Co3Si":
        return 503, "busy"
    if parameters.get("formula") == "NiSi2":
        return 200, "not json"
    if "thermo" in url:
        return 200, '{"data": [{"material_id": "%s", "energy_above_hull": 0.01}]}' % parameters["material_ids"]
    return 200, '{"response": {"docs": [{"material_id": "mp-%s", "formula": "%s", "symmetry": {"symbol": "Pnma", "number": 62}}]}}' % (parameters["formula"], parameters["formula"])


def reference_service(spark, sf_dir):
    own = materials.identities(material_points(spark, sf_dir), {"monosilicide": "NiSi"})
    got = materials.fetch_references(own.where("formula <> ''"), "veinstone.plans.dual:service", api_key="k")
    flat = own.select("point_id", "query_key").join(got, "query_key").select("point_id", "status", "error", F.get("references", F.lit(0)).alias("r"))
    return flat.select("point_id", "status", F.substring_index("error", ":", 1).alias("error"), "r.material_id", "r.spacegroup_number", "r.energy_above_hull")


SERVICE_SQL = f"""with {IDENTITY} select point_id, case formula when 'Co3Si' then 'fetch_error' when 'NiSi2' then 'parse_error' else 'success' end as status, case formula when 'Co3Si' then 'http_503' when 'NiSi2' then 'JSONDecodeError' else '' end as error,
  case when formula in ('Ni2Si', 'NiSi') then 'mp-' || formula end as material_id, case when formula in ('Ni2Si', 'NiSi') then '62' end as spacegroup_number, case when formula in ('Ni2Si', 'NiSi') then 0.01::double end as energy_above_hull from i where formula <> ''"""


# --- dual graphs ---------------------------------------------------------------------------------


def graph_points(spark, sf_dir):
    n = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    k = F.col("l_partkey")
    p = lines(spark, sf_dir).join(looked_up(n, "suppliers"), F.col("l_suppkey") == F.col("s_suppkey")).withColumn("point_id", point_key())
    return p.select(
        "point_id", (F.col("l_orderkey") % 500).cast("string").alias("article_key"), pick(FORMULAS, k).alias("phase_label"), F.col("n_name").alias("substrate_material"), pick(("(111)", "<111>", "(100)", ""), k).alias("substrate_orientation"), pick(("PVD", "ALD", "CVD"), F.col("l_linenumber")).alias("method_family"),
        pick(('["Pt"]', "['Au']", ""), k).alias("doping_elements"), pick(("doped", "undoped"), k).alias("doping_state"), (1 - F.col("l_discount")).alias("confidence"), F.lit("u").alias("citation_url"), F.when(F.col("l_linenumber") == 1, "").otherwise("line:1").alias("locator"), F.lit("s").alias("snippet"),
        (F.col("l_quantity") * 20).alias("anneal_temperature_c"), (F.col("l_quantity")).alias("thickness_nm"), F.col("l_tax").alias("mp_energy_above_hull_min"), pick(("supports", "neutral", "conflicts", "insufficient", ""), F.col("l_linenumber")).alias("mp_interpretation_label"), pick(("62", "225", ""), k).alias("spacegroup_number"),
    )


def process_graph(spark, sf_dir):
    nodes, edges = graphs.process_graph(graph_points(spark, sf_dir))
    count = lambda t, c, kind: t.groupBy(F.col(c).alias("type")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    return count(nodes, "node_type", "node").unionByName(count(edges, "edge_type", "edge"))


OWN_NODES = [k for k in graphs.OWN]
POINTS = f"""p as (select *, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice::decimal(18,2)) as point_id, (l_orderkey % 500)::varchar as article, {duck(FORMULAS, 'l_partkey')} as phase, {duck(('111', '111', '100', 'unknown_orientation'), 'l_partkey')} as orientation,
  {duck(('PVD', 'ALD', 'CVD'), 'l_linenumber')} as method, {duck(('62', '225', ''), 'l_partkey')} as sg, 1 - l_discount as conf from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)"""
PROCESS_SQL = f"""with {POINTS}, c as (select count(*) as n, count(distinct article) as a, count(distinct lower(n_name)) as s, count(distinct orientation) as o, count(distinct case when l_partkey % 3 = 0 then 'pt' else ['doped', 'undoped'][l_partkey % 2 + 1] end) as d, count(distinct method) as m from p)
select 'node' as kind, t as type, case t when 'article' then a when 'substrate' then s when 'substrate_orientation' then o when 'dopant_signature' then d when 'alloy_signature' then 1 when 'precursor' then 1 when 'method_step_deposition' then m when 'method_step_anneal' then m else n end as n
from c, (select unnest([{', '.join(repr(k) for k in [*graphs.SHARED, *graphs.OWN])}]) as t) union all
select 'edge', t, case t when 'phase_instance_observed_under_condition' then 2 * n else n end from c, (select unnest([{', '.join(repr(k) for k in dict.fromkeys(e[2] for e in graphs.PROCESS_EDGES))}]) as t)"""


def concept_graph(spark, sf_dir):
    """The concepts that points name, and those edges that formulas and substrates have; seeds aside."""
    nodes, edges = graphs.concept_graph(graph_points(spark, sf_dir), seeded=False)
    some = nodes.where(F.col("concept_type").isin("formula", "element", "stoich_component", "space_group", "crystal_system", "orientation_family", "substrate_material")).select(F.lit("node").alias("kind"), F.col("concept_type").alias("type"), F.col("concept_id").alias("id"))
    return some.union(edges.select(F.lit("edge"), "edge_type", F.concat_ws(">", "source_id", "target_id")))


CONCEPT_SQL = f"""with {POINTS}, f as (select *, case when phase = 'unknown' then 'unknown_formula' else lower(phase) end as fk, case when phase = 'unknown' then [] else list_distinct(regexp_extract_all(phase, '[A-Z][a-z]?')) end as el,
  case when phase = 'unknown' then [] else regexp_extract_all(phase, '([A-Z][a-z]?)([0-9]*)', 1) end as names, case when phase = 'unknown' then [] else regexp_extract_all(phase, '([A-Z][a-z]?)([0-9]*)', 2) end as counts, regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g') as sub from p),
st as (select distinct fk, lower(unnest(names)) || '_' || case when unnest(counts) = '' then '1' else unnest(counts) end || '_0000' as t from f),
cs as (select distinct 'sg' || sg as g, case sg when '62' then 'orthorhombic' else 'cubic' end as c from f where sg <> '')
select distinct 'node' as kind, 'formula' as type, 'concept:formula:' || fk as id from f union select 'node', 'element', 'concept:element:' || lower(unnest(el)) from f union select 'node', 'stoich_component', 'concept:stoich_component:' || t from st
union select 'node', 'space_group', 'concept:space_group:' || g from cs union select 'node', 'crystal_system', 'concept:crystal_system:' || c from cs union select 'node', 'orientation_family', 'concept:orientation_family:' || orientation from f union select 'node', 'substrate_material', 'concept:substrate_material:' || sub from f
union select 'edge', 'formula_has_element', 'concept:formula:' || fk || '>concept:element:' || lower(unnest(el)) from f union select 'edge', 'formula_has_stoich_component', 'concept:formula:' || fk || '>concept:stoich_component:' || t from st
union select 'edge', 'formula_has_space_group', 'concept:formula:' || fk || '>concept:space_group:sg' || sg from f where sg <> '' union select 'edge', 'space_group_in_crystal_system', 'concept:space_group:' || g || '>concept:crystal_system:' || c from cs
union select 'edge', 'substrate_has_orientation_family', 'concept:substrate_material:' || sub || '>concept:orientation_family:' || orientation from f"""


def dual_bridges(spark, sf_dir):
    p = graph_points(spark, sf_dir)
    made = graphs.bridge_candidates(p, graphs.concept_graph(p)[0], ["film_gate", "substrate", "method", "thermo"], 0.62)
    return made.groupBy("gate_type", "keep").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("weight"), 5).alias("mean_weight"))


BRIDGES_SQL = f"""with {POINTS}, f as (select *, case when phase = 'unknown' then [] else list_distinct(regexp_extract_all(phase, '[A-Z][a-z]?')) end as el, case when l_linenumber = 1 then 2.0::double / 3 else 1 end as pq, [1.0, 0.6, 0.2, 0.4, 0.5][l_linenumber % 5 + 1]::double as mp from p),
fs as (select phase, least(1, count(distinct article) / 3) as s from f where phase <> 'unknown' group by 1), es as (select e, least(1, count(distinct article) / 3) as s from (select article, unnest(el) as e from f) group by 1), ss as (select n_name, least(1, count(distinct article) / 3) as s from f group by 1),
c as (select 'film' as g, 0.95 as px, coalesce(fs.s, 0.3) as a, conf, pq, mp from f left join fs using (phase) union all select 'film', 0.95, es.s, conf, pq, mp from (select *, unnest(el) as e from f) x join es using (e)
  union all select 'substrate', 0.85, ss.s, conf, pq, mp from f join ss using (n_name) union all select 'substrate', 0.85, 0.4, conf, pq, mp from f union all select 'precursor', 0.75, 0.35, conf, pq, mp from f union all select 'method', 0.85, 0.4, conf, pq, mp from f
  union all select 'method', 0.85, 0.35, conf, pq, mp from f union all select 'thermo', 0.75, 0.30, conf, pq, mp from f union all select 'electronic', 0.75, 0.30, conf, pq, mp from f),
w as (select g, 0.35 * conf + 0.20 * pq + 0.15 * px + 0.15 * a + 0.15 * mp as w from c)
select g || '_gate' as gate_type, g in ('film', 'substrate', 'method', 'thermo') and round(w, 9) >= 0.62 as keep, count(*) as n, round(avg(w), 5)::double as mean_weight from w group by all"""


def dual_audit(spark, sf_dir):
    """The audit of graphs that lack the outcomes' nodes and the stability bands."""
    return graphs.dual_audit_of(graph_points(spark, sf_dir), {"quality_outcome"}, {"stability_band"})


def bridge_features(spark, sf_dir):
    p = graph_points(spark, sf_dir)
    kept = graphs.bridge_edges(graphs.bridge_candidates(p, graphs.concept_graph(p)[0], ["thermo"], 0.6))
    return graphs.bridge_features(p.select("point_id"), kept).select("point_id", "concept_bridge_count", F.round("concept_bridge_mean_weight", 6).alias("mean"), F.round("concept_gate_coverage", 6).alias("coverage"))


FEATURES_SQL = f"""with {POINTS}, w as (select point_id, 0.35 * conf + 0.20 * case when l_linenumber = 1 then 2.0::double / 3 else 1 end + 0.15 * 0.75 + 0.15 * 0.30 + 0.15 * [1.0, 0.6, 0.2, 0.4, 0.5][l_linenumber % 5 + 1]::double as w from p)
select point_id, case when round(w, 9) >= 0.6 then 1 else 0 end::double as concept_bridge_count, round(case when round(w, 9) >= 0.6 then w else 0 end, 6) as mean, round(case when round(w, 9) >= 0.6 then 1 / 7 else 0 end, 6)::double as coverage from w"""


# --- knowledge, benchmarks -----------------------------------------------------------------------


def phase_events(spark, sf_dir):
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").withColumn("snippet", F.concat(F.lit("sputtered, "), F.col("p_size").cast("string"), pick((" min at 2 torr", " s, smooth"), k)))
    long = p.select(F.col("p_partkey").cast("string").alias("point_id"), F.explode(F.when(k % 4 < 3, F.array(F.lit("thickness_nm"), F.lit("temperature_c"))).otherwise(F.array(F.lit("thickness_nm")))).alias("variable_name"), "p_size", pick(FORMULAS, k).alias("entity"), "snippet", F.lit(0.9).alias("confidence"), F.lit("a").alias("article_key"))
    rows = long.withColumn("normalized_value", F.when(F.col("variable_name") == "thickness_nm", F.col("p_size").cast("double")).otherwise(F.col("p_size") * 10.0)).withColumn("ord", F.concat_ws("|", "point_id", "variable_name"))
    return knowledge.phase_events(rows, "thickness_nm", "temperature_c", "ord")


def phase_events_query(spark, sf_dir):
    return phase_events(spark, sf_dir).select("event_id", "point_id", "phase_label", "thickness_nm", "anneal_temperature_c", "anneal_time_s", F.round("pressure_pa", 3).alias("pressure_pa"), "film_quality_label", "method_family")


EVENTS_SQL = f"""select substr(sha1(p_partkey || '|' || {duck(FORMULAS, 'p_partkey')} || '|' || p_size || '.0|' || p_size * 10 || '.0'), 1, 20) as event_id, p_partkey::varchar as point_id, {duck(FORMULAS, 'p_partkey')} as phase_label, p_size::double as thickness_nm, p_size * 10::double as anneal_temperature_c,
  p_size * case when p_partkey % 2 = 0 then 60 else 1 end::double as anneal_time_s, case when p_partkey % 2 = 0 then 266.644::double end as pressure_pa, case when p_partkey % 2 = 0 then 'unknown' else 'uniform' end as film_quality_label, 'PVD' as method_family from part where p_partkey % 4 < 3"""


def phase_suite(spark, sf_dir):
    e = phase_events(spark, sf_dir)
    return knowledge.phase_suite(e).join(knowledge.quality_outcomes(e).agg(F.count("event_id").alias("outcomes")))


def matched_context(spark, sf_dir):
    """Greedy matches with the context of both sides."""
    pred, gold = gold_and_pred(spark, sf_dir)
    found = joins.greedy_match(pred, gold, "entity", "x", "y", 2.0, 8.0, "k")
    side = lines(spark, sf_dir).select(point_key().alias("k"), F.col("l_linestatus").alias("substrate_material"), F.lit("(100)").alias("substrate_orientation"), pick(("doped", "undoped"), F.col("l_linenumber")).alias("doping_state"), F.lit("pure").alias("alloy_state"))
    other = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("gold_id"), F.when(F.col("p_size") > 25, "O").otherwise("f").alias("gold_substrate_material"), F.lit("(100)").alias("gold_substrate_orientation"), pick(("doped", "undoped"), F.col("p_size")).alias("gold_doping_state"), F.lit("Pure ").alias("gold_alloy_state"))
    return pred, gold, knowledge.context_match(found.join(side, "k").join(other, "gold_id"))


def context_scores(spark, sf_dir):
    return knowledge.context_scores(*matched_context(spark, sf_dir))


def context_errors(spark, sf_dir):
    pred, _, matched = matched_context(spark, sf_dir)
    return knowledge.context_errors(pred, matched, "k")


def label_precision(spark, sf_dir):
    pred, gold = gold_and_pred(spark, sf_dir)
    at = ["entity", "x", "y"]
    first = joins.band_candidates(joins.places(pred, *at), gold.groupBy(*at).agg(F.min("gold_id").alias("gold_id")), *at, 2.0, 8.0).groupBy(*at).agg(F.min("gold_id").alias("gold_id"))
    near = pred.join(first, at).select("k", "gold_id", "x", "entity")
    marked = near.withColumns({"mp_interpretation_label": F.when(F.col("x") % 2 == 0, "Supports").otherwise("neutral"), "mp_expected_label": pick(("supports", "conflicts", ""), F.col("gold_id"))})
    return knowledge.labelled_precision(marked, "k").withColumn("mp_support_precision", F.round("mp_support_precision", 6))


PRECISION_SQL = """with p as (select concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice::decimal(18,2)) as k, l_quantity as x, l_extendedprice / 1000 as y, l_returnflag as entity from lineitem),
g as (select p_partkey as gold_id, p_size * 12.0 as gx, p_retailprice % 100 as gy, ['A', 'N', 'R'][p_partkey % 3 + 1] as entity from part),
j as (select k, any_value(x) as x, min(gold_id) as g from p join g using (entity) where abs(x - gx) <= 2 and abs(y - gy) <= 8 group by 1)
select count(*) as labeled_rows, round(case when count(*) filter (x % 2 = 0) > 0 then count(*) filter (x % 2 = 0 and g % 3 = 0) / count(*) filter (x % 2 = 0) else 0 end, 6)::double as mp_support_precision from j where g % 3 < 2"""


def reference_metrics(spark, sf_dir):
    p = evidence(spark, sf_dir).withColumn("mp_status", F.when(F.col("entity") == "A", "success").otherwise(""))
    return knowledge.reference_metrics(p).select(*[F.round(c, 6).alias(c) for c in ("mp_coverage", "mp_support_rate", "mp_conflict_rate")])


def reference_alignment(spark, sf_dir):
    return knowledge.reference_alignment(evidence(spark, sf_dir)).withColumn("supported", F.round("supported", 6))


ALIGNMENT_SQL = "select entity, round(avg((t <= 0.06)::int), 6) as supported from (select case when l_linenumber = 2 then 'unknown' else lower(l_returnflag) end as entity, l_tax as t from lineitem where l_linenumber <> 1) group by 1"


def vote_suite(spark, sf_dir):
    v = lines(spark, sf_dir).select((F.col("l_returnflag") != "N").alias("accepted"), (1 - F.col("l_discount")).alias("aggregated_support"))
    return knowledge.vote_suite(v).withColumns({c: F.round(c, 6) for c in ("accepted_ratio", "mean_support")})


# --- recipes -------------------------------------------------------------------------------------

REQUEST = {"film_material": "NiSi", "phase_type": "phase_label", "phase_value": "nisi2", "methods": ["PVD", "ald"], "bounds": {"thickness_nm": (5.0, 30.0), "anneal_temperature_c": (None, 400.0)}, "max_candidates": 10**9, "references": [{"formula_pretty": "NiSi2", "spacegroup_symbol": "Fm-3m"}]}


def recipe_events(spark, sf_dir):
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("event_id"), pick(FORMULAS, k).alias("phase_label"), F.lit("").alias("film_material"), F.lit("").alias("snippet"), F.lit("Si").alias("substrate_material"), F.col("p_size").cast("double").alias("thickness_nm"), (F.col("p_size") * 10.0).alias("anneal_temperature_c"), ((F.col("p_size") % 11) / 10).alias("film_quality_score_numeric"), pick(("supports", "conflicts", "neutral"), k).alias("mp_interpretation_label"), (F.col("p_size") / 50).alias("mp_interpretation_score"))


def recipe_candidates(spark, sf_dir):
    out = recipes.candidates(recipe_events(spark, sf_dir), REQUEST)
    return out.select("event_id", "method_family", "precursor", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("target_satisfaction", "evidence", "reproducibility", "uncertainty")], "recipe_id")


RECIPES_SQL = f"""with e as (select p_partkey as event_id, p_size, {duck(FORMULAS, 'p_partkey')} as phase, (p_size % 11) / 10.0::double as q, p_size / 50.0::double as s, p_partkey % 3 as l from part where p_partkey % 5 = 2),
b as (select *, 0.04 + 0.02 as bonus, least(0.35 + 0.45 * q + 0.20, 1) as e0, least(0.30 + 0.40 * q + 0.30, 1) as r0, greatest(1 - case when p_size < 5 or p_size > 30 then 0.25 else 0 end - case when p_size * 10 > 400 then 0.25 else 0 end, 0) as target_satisfaction from e),
m as (select *, least(greatest(least(greatest(e0 + case l when 0 then 0.08 * s when 1 then -0.14 * (1 - s) else 0.02 * s end, 0), 1) + 0.5 * bonus, 0), 1) as evidence, least(greatest(least(greatest(r0 + case l when 0 then 0.06 * s when 1 then -0.10 * (1 - s) else 0 end, 0), 1) + 0.35 * bonus, 0), 1) as reproducibility from b)
select event_id, t.m as method_family, t.p as precursor, round(target_satisfaction + 1e-9, 5)::double as target_satisfaction, round(evidence + 1e-9, 5)::double as evidence, round(reproducibility + 1e-9, 5)::double as reproducibility, round(least(greatest(1 - (0.6 * evidence + 0.4 * reproducibility), 0), 1) + 1e-9, 5)::double as uncertainty,
  'rcp_' || substr(sha1(event_id || '|' || t.m || '|' || p_size || '.000|' || p_size * 10 || '.000|120.000|0'), 1, 14) as recipe_id from m, (values ('PVD', 'sputter target'), ('ALD', 'metal-organic precursor')) t(m, p)"""


def recipe_blend(spark, sf_dir):
    c = recipes.candidates(recipe_events(spark, sf_dir), REQUEST).withColumns({"processor_phase_prob": F.lit(0.8), "processor_quality_score": F.lit(0.5), "processor_uncertainty": F.lit(0.2)})
    return recipes.blended(c).select("recipe_id", F.round(F.col("film_quality_score_numeric") + 1e-9, 5).alias("quality"), F.round(F.col("uncertainty") + 1e-9, 5).alias("uncertainty"))


BLEND_SQL = RECIPES_SQL.replace("select event_id, t.m as method_family", "select (p_size % 11) / 10.0::double as q, event_id, t.m as method_family").replace("with e as", "with x as (with e as", 1) + ") select recipe_id, round(0.60 * q + 0.40 * 0.5 + 1e-9, 5)::double as quality, round(0.50 * (uncertainty - 1e-9) + 0.5 * 0.2 + 1e-9, 5)::double as uncertainty from x"


def recipe_cards(spark, sf_dir):
    e = recipe_events(spark, sf_dir)
    ranked, every = recipes.generate(e, REQUEST, [("too_thick", F.col("thickness_nm") > 40)], retries=1, top_k=3)
    card = recipes.cards(ranked, REQUEST).select("recipe_id", F.get_json_object("card", "$.target.film_material").alias("material"), F.get_json_object("card", "$.method_flow.anneal.action").alias("second_step"))
    return card.join(every.agg(F.count(F.lit(1)).alias("n_candidates")))


def planned(spark, sf_dir):
    p = recipes.proposed(recipe_events(spark, sf_dir), "nisi2", 25, "event_id")
    return p.select("event_id", F.round(recipes.support_hint(F.col("film_quality_score_numeric")), 6).alias("hint"))


# --- training ------------------------------------------------------------------------------------


def training_rows(spark, sf_dir):
    """Points with the reference and auxiliary features of their part, of several rows the first, and their phase's id."""
    rows = graph_points(spark, sf_dir).withColumn("part", F.split("point_id", r"\|")[2])
    feats = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("part"), F.lit("2").alias("o"), (F.col("p_size") / 50).alias("mp_interpretation_score"), F.col("p_size").alias("aux_size"))
    double = feats.union(feats.withColumns({"o": F.lit("1"), "aux_size": F.col("aux_size") + 100}))
    joined = training.with_auxiliary(training.replaced(rows, double, training.REFERENCE, "part", "o"), double, "part", "o")
    named = training.with_phase(joined.withColumn("mp_spacegroup_number", F.col("spacegroup_number")), training.phase_specs(joined.withColumn("mp_spacegroup_number", F.col("spacegroup_number"))))
    return named.groupBy("phase_id", "reduced_formula").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("mp_interpretation_score"), 6).alias("score"), F.sum("aux_size").alias("aux"))


TRAINING_SQL = f"""with {POINTS}, f as (select case when phase = 'unknown' then '' else phase end as formula, sg, l_partkey from p),
s as (select *, sha1('{{"reduced_formula": "' || formula || '", "spacegroup_number": "' || sg || '", "spacegroup_symbol": "", "stoich": [' || case formula when 'NiSi' then '{{"element": "Ni", "ratio": 1.0}}, {{"element": "Si", "ratio": 1.0}}' when 'Ni2Si' then '{{"element": "Ni", "ratio": 2.0}}, {{"element": "Si", "ratio": 1.0}}'
  when 'NiSi2' then '{{"element": "Ni", "ratio": 1.0}}, {{"element": "Si", "ratio": 2.0}}' when 'CoSi2' then '{{"element": "Co", "ratio": 1.0}}, {{"element": "Si", "ratio": 2.0}}' else '' end || ']}}') as sig from f)
select 'phase_' || substr(sha1(sig), 1, 16) as phase_id, formula as reduced_formula, count(*) as n, round(avg(p_size / 50), 6) as score, sum(p_size + 100)::bigint as aux from s join part on l_partkey = p_partkey group by all"""


def finetune_slice(spark, sf_dir):
    rows = graph_points(spark, sf_dir)
    return training.finetune_slice(rows, "nisi", 20.0, dopants=["pt"]).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("thickness_nm"), 3).alias("thickness"))


def article_summary(spark, sf_dir):
    rows = graph_points(spark, sf_dir).select("article_key", "phase_label", "method_family", "thickness_nm")
    out = training.article_summary(rows, ["phase_label", "method_family"], ["thickness_nm"])
    return out.select("article_key", "n_rows", F.round("mean_thickness_nm", 6).alias("mean_thickness"), F.array_join("phase_label_values", ",").alias("phases"), "n_method_family")


def holdout_split(spark, sf_dir):
    train, test = training.holdout(graph_points(spark, sf_dir).select("article_key"), 0.25)
    both = train.select("article_key", F.lit("train").alias("side")).union(test.select("article_key", F.lit("test")))
    return both.groupBy("article_key").agg(F.countDistinct("side").alias("sides"))


REGISTRY = {
    "row_reasons": (row_reasons, f"with {REASONS} select point_id, array_to_string(codes, ';') as reasons from w"),
    "context_taxonomy": (context_taxonomy, f"with {REASONS}, e as (select unnest(codes) as reason from w) select reason, count(*) as n from e where regexp_matches(reason, 'substrate|orientation|doping|alloy|composition|pure_ni') group by 1"),
    "conflict_warnings": (conflict_warnings, "select 'mp_conflict' as reason, 'conflicts' as mp_interpretation_label, count(*) as n from lineitem where l_tax > 0.06 having count(*) > 0"),
    "gate_payload": (gate_payload, PAYLOAD_SQL),
    "material_identity": (material_identity, IDENTITY_SQL),
    "material_interpretation": (material_interpretation, INTERPRETATION_SQL),
    "reference_service": (reference_service, SERVICE_SQL),
    "process_graph": (process_graph, PROCESS_SQL),
    "concept_graph": (concept_graph, CONCEPT_SQL),
    "dual_bridges": (dual_bridges, BRIDGES_SQL),
    "dual_audit": (dual_audit, f"with {POINTS} select count(*) as process_orphans, 0::bigint as concept_orphans, count(*) as bridge_orphans, 0::bigint as bad_weights, 0::bigint as bad_precedence, count(*) = 0 as ok from p"),
    "bridge_features": (bridge_features, FEATURES_SQL),
    "phase_events": (phase_events_query, EVENTS_SQL),
    "phase_suite": (phase_suite, f"select count(*) as phase_event_count, count(distinct {duck(FORMULAS, 'p_partkey')}) as phase_diversity, count(*) as outcomes from part where p_partkey % 4 < 3"),
    "context_scores": (context_scores, None),
    "context_errors": (context_errors, None),
    "label_precision": (label_precision, PRECISION_SQL),
    "reference_metrics": (reference_metrics, "select round(avg((l_linenumber > 2 and l_returnflag = 'A')::int), 6) as mp_coverage, round(avg((l_tax <= 0.06)::int), 6) as mp_support_rate, round(avg((l_tax > 0.06)::int), 6) as mp_conflict_rate from lineitem"),
    "reference_alignment": (reference_alignment, ALIGNMENT_SQL),
    "vote_suite": (vote_suite, "select count(*) as vote_rows, round(avg((l_returnflag <> 'N')::int), 6) as accepted_ratio, round(avg(1 - l_discount), 6) as mean_support from lineitem"),
    "recipe_candidates": (recipe_candidates, RECIPES_SQL),
    "recipe_blend": (recipe_blend, BLEND_SQL),
    "recipe_cards": (recipe_cards, None),
    "planned": (planned, "select event_id, round(least(greatest(0.45 + 0.50 * q, 0), 1), 6)::double as hint from (select p_partkey as event_id, (p_size % 11) / 10.0::double as q from part where p_partkey % 5 = 2 order by 1 limit 25)"),
    "training_rows": (training_rows, TRAINING_SQL),
    "finetune_slice": (finetune_slice, f"with {POINTS} select count(*) as n, round(sum(l_quantity), 3) as thickness from p where phase = 'NiSi' and l_quantity <= 20 and l_partkey % 3 = 0"),
    "article_summary": (article_summary, f"with {POINTS} select article as article_key, count(*) as n_rows, round(avg(l_quantity), 6) as mean_thickness, string_agg(distinct phase, ',' order by phase) as phases, count(distinct method) as n_method_family from p group by 1"),
    "holdout_split": (holdout_split, f"with {POINTS} select distinct article as article_key, 1::bigint as sides from p"),
}
