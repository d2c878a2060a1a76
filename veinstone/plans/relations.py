"""Queries over the relational tables: special joins, graphs, bridges, recipes, gates, Spark's own grouping forms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veinstone.functions import science
from veinstone.operators import evidence, graphs, joins, models, recipes
from veinstone.plans.evidence import KEY, lines, point_key, read


def conversations(spark, sf_dir):
    return read(spark, sf_dir, "conversations")


def nearest_context(spark, sf_dir):
    c = conversations(spark, sf_dir).withColumn("n", F.length("text"))
    rows = c.where("role = 'assistant'").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "conv_id", F.col("turn").alias("line"))
    ctx = c.where("role = 'user'").select("conv_id", F.col("turn").alias("line"), F.col("n").alias("score"), F.sha1(F.col("text").cast("binary")).alias("context"))
    return joins.nearest_context(rows, ctx, "conv_id", "line", "id")


NEAREST_CONTEXT_SQL = """with a as (select conv_id || '-' || turn as id, conv_id, turn from conversations where role = 'assistant'), u as (select conv_id, turn as t, length(text) as s, sha1(text) as context from conversations where role = 'user'),
j as (select a.id, u.context, case when a.turn = 0 or u.t = 0 then 999999 else abs(a.turn - u.t) end as gap, u.s, u.t from a join u using (conv_id)),
r as (select *, row_number() over (partition by id order by gap, s desc, t) as rn, min(gap) over (partition by id) as g from j)
select id, context, g as gap from r where rn = 1"""


def window_assemble(spark, sf_dir):
    rows = lines(spark, sf_dir).select(F.col("l_orderkey").alias("article"), F.col("l_linenumber").alias("line"), F.when(F.col("l_returnflag") == "N", "x").otherwise("y").alias("variable_name"), F.col("l_quantity").alias("value"), (1 - F.col("l_discount")).alias("confidence"), point_key().alias("k"))
    return joins.window_assemble(evidence.keep_one(rows, ["article", "line", "variable_name"], [F.asc("k")]), "article", "line", 1)


ASSEMBLE_SQL = f"""with r as (select l_orderkey as article, l_linenumber as line, case when l_returnflag = 'N' then 'x' else 'y' end as v, l_quantity as value, 1 - l_discount as c, {KEY} as k from lineitem),
o as (select * from (select *, row_number() over (partition by article, line, v order by k) as rn from r) where rn = 1),
n as (select a.article, a.line as anchor, o.v, o.value, row_number() over (partition by a.article, a.line, o.v order by abs(o.line - a.line), -o.c, o.line) as rn from (select distinct article, line from o) a join o on o.article = a.article and o.line between a.line - 1 and a.line + 1)
select article, anchor, max(value) filter (v = 'x') as x, max(value) filter (v = 'y') as y from n where rn = 1 group by all"""


def rank_zip(spark, sf_dir):
    r = lines(spark, sf_dir).select("l_partkey", point_key().alias("k"), "l_returnflag", "l_discount")
    a, b = r.where("l_returnflag = 'N'").select("l_partkey", F.col("k").alias("x_id"), F.col("l_discount").alias("dx")), r.where("l_returnflag = 'R'").select("l_partkey", F.col("k").alias("y_id"), F.col("l_discount").alias("dy"))
    return joins.rank_zip(a, b, "l_partkey", [F.asc("dx"), F.asc("x_id")], [F.asc("dy"), F.asc("y_id")], 4).select("l_partkey", "rank", "x_id", "y_id")


RANKZIP_SQL = f"""with r as (select l_partkey, {KEY} as k, l_returnflag as f, row_number() over (partition by l_partkey, l_returnflag order by l_discount, {KEY}) as rank from lineitem)
select a.l_partkey, a.rank::int as rank, a.k as x_id, b.k as y_id from r a join r b on a.l_partkey = b.l_partkey and a.rank = b.rank where a.f = 'N' and b.f = 'R' and a.rank <= 4"""


def as_of(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    rows = e.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    facts = e.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("last_view"))
    return joins.as_of(rows, facts, "user_id", "ts", "last_view").select("event_id", "last_view")


def gold_and_pred(spark, sf_dir):
    pred = lines(spark, sf_dir).select(point_key().alias("k"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), F.col("l_returnflag").alias("entity"))
    gold = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("gold_id"), (F.col("p_size") * 12.0).alias("x"), (F.col("p_retailprice") % 100).alias("y"), F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("p_partkey") % 3 + 1).cast("int")).alias("entity"))
    return pred, gold


def tolerance_candidates(spark, sf_dir):
    pred, gold = gold_and_pred(spark, sf_dir)
    return joins.band_counts(pred, gold, "entity", "x", "y", 2.0, 8.0, "k")


GOLD = f"""p as (select {KEY} as k, l_quantity as x, l_extendedprice / 1000 as y, l_returnflag as entity, l_linestatus as status, l_discount as d from lineitem),
g as (select p_partkey as gold_id, p_size * 12.0 as gx, p_retailprice % 100 as gy, ['A', 'N', 'R'][p_partkey % 3 + 1] as entity, p_type from part)"""


def tolerance_match(spark, sf_dir):
    pred, gold = gold_and_pred(spark, sf_dir)
    return joins.greedy_match(pred, gold, "entity", "x", "y", 2.0, 8.0, "k")


def match_scores(spark, sf_dir):
    pred, gold = gold_and_pred(spark, sf_dir)
    tp = tolerance_match(spark, sf_dir).agg(F.count(F.lit(1)).alias("tp"))
    n = pred.agg(F.count(F.lit(1)).alias("n_pred")).join(gold.agg(F.count(F.lit(1)).alias("n_gold"))).join(tp)
    return n.select("tp", *joins.prf(F.col("tp"), F.col("n_pred") - F.col("tp"), F.col("n_gold") - F.col("tp")))


def nearest_gold(spark, sf_dir):
    pred, gold = gold_and_pred(spark, sf_dir)
    near = joins.nearest(pred, gold.withColumn("gold_entity", F.col("entity")), "x", "y", "k", 4.0, ("entity",), ("gold_entity",))
    return near.select("k", "gold_id", F.round("distance", 6).alias("distance"), joins.miss_reason(F.col("entity"), F.col("gold_entity"), F.col("dx"), F.col("dy"), 2.0, 8.0).alias("reason"))


#: Gold rows of one place and their least id of each: as many as differ.
NEAREST_SQL = f"""with {GOLD}, u as (select gx, gy, min(gold_id) as gold_id, arg_min(entity, gold_id) as ge from g group by 1, 2), q as (select distinct x, y from p),
j as (select x, y, arg_min({{'id': gold_id, 'ge': ge, 'dx': abs(x - gx), 'dy': abs(y - gy)}}, {{'d': round(abs(x - gx) + abs(y - gy), 9), 'i': gold_id}}) as b from q, u group by 1, 2)
select k, b.id as gold_id, round(b.dx + b.dy, 6)::double as distance, case when entity <> b.ge then 'entity_mismatch' when b.dx > 2 and b.dy > 8 then 'x_y_outside_tolerance' when b.dx > 2 then 'x_outside_tolerance' when b.dy > 8 then 'y_outside_tolerance' else 'duplicate_or_collision' end as reason
from p join j using (x, y)"""


def cross_models(spark, sf_dir):
    """Every pair of two tables of fixed size."""
    return read(spark, sf_dir, "region").select("r_name").crossJoin(read(spark, sf_dir, "nation").select("n_name"))


def orders(spark, sf_dir):
    return read(spark, sf_dir, "orders")


def cooccurrence_pairs(spark, sf_dir):
    o = orders(spark, sf_dir).join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return graphs.cooccurrence(o, "o_orderkey", {"status": F.col("o_orderstatus"), "priority": F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")), "year": F.year("o_orderdate"), "segment": F.col("c_mktsegment")})


COOC_SQL = """with t as (select o_orderkey, unnest(list_sort(list_filter(['status:' || o_orderstatus, case when o_orderkey % 5 > 0 then 'priority:' || o_orderpriority end, 'year:' || year(o_orderdate), 'segment:' || c_mktsegment], lambda x: x is not null))) as v from orders join customer on o_custkey = c_custkey)
select a.v as a, b.v as b, count(*) as n from t a join t b on a.o_orderkey = b.o_orderkey and a.v < b.v group by all"""


def cross_source_support(spark, sf_dir):
    return graphs.cross_source_support(lines(spark, sf_dir), "l_partkey", "l_suppkey").select("l_partkey", F.round("support", 6).alias("support"))


def frequency_features(spark, sf_dir):
    return graphs.frequency_features(read(spark, sf_dir, "part"), {"p_brand": 0.5, "p_type": 0.3, "p_size": 0.2}).select("p_partkey", "p_brand_degree", "p_type_degree", "p_size_degree", F.round("support", 6).alias("support"))


FREQ_SQL = """with c as (select *, count(*) over (partition by p_brand) as b, count(*) over (partition by p_type) as t, count(*) over (partition by p_size) as s, count(*) over () as n from part)
select p_partkey, b as p_brand_degree, t as p_type_degree, s as p_size_degree, round(0.5::double * b / n + 0.3::double * t / n + 0.2::double * s / n, 6) as support from c"""


def bridge_links(spark, sf_dir):
    p = lines(spark, sf_dir).join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("source_point_id"), F.col("p_type").alias("film"), F.col("p_brand").alias("substrate"), F.col("l_returnflag").alias("method"), (1 - F.col("l_discount")).alias("confidence"))
    concepts = read(spark, sf_dir, "part").select(F.lit("film").alias("concept_type"), F.lower("p_type").alias("key")).union(read(spark, sf_dir, "part").where("p_size < 20").select(F.lit("substrate"), F.lower("p_brand"))).union(lines(spark, sf_dir).where("l_returnflag <> 'N'").select(F.lit("method"), F.lower("l_returnflag"))).distinct()
    weight = lambda proximity: science.bridge_weight(F.col("confidence"), F.lit(2 / 3), proximity, F.lit(0.3), F.lit(0.5))
    return graphs.bridges(p, concepts, {"film": (F.col("film"), 0.95), "substrate": (F.col("substrate"), 0.85), "method": (F.col("method"), 0.70)}, weight, 0.69)


def bridge_weight(spark, sf_dir):
    return bridge_links(spark, sf_dir).groupBy("concept_type", "kept").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("weight"), 6).alias("mean_weight"))


BRIDGE = """with pts as (select l_orderkey as id, 1 - l_discount as c, unnest([{'t': 'film', 'k': lower(p_type), 'p': 0.95::double}, {'t': 'substrate', 'k': lower(p_brand), 'p': 0.85::double}, {'t': 'method', 'k': lower(l_returnflag), 'p': 0.70::double}]) as e from lineitem join part on l_partkey = p_partkey),
con as (select distinct 'film' as t, lower(p_type) as k from part union select 'substrate', lower(p_brand) from part where p_size < 20 union select 'method', lower(l_returnflag) from lineitem where l_returnflag <> 'N'),
b as (select id, e.t as t, 0.35 * c + 0.20 * (2.0::double / 3) + 0.15 * e.p + 0.15 * 0.3 + 0.15 * 0.5 as w from pts join con on con.t = e.t and con.k = e.k)"""


def bridge_stats(spark, sf_dir):
    return graphs.bridge_stats(bridge_links(spark, sf_dir), "source_point_id", 7).select("source_point_id", "n_bridges", F.round(F.col("mean_weight") + 1e-9, 5).alias("mean_weight"), F.round("max_weight", 6).alias("max_weight"), F.round("coverage", 6).alias("coverage"))


def supply(spark, sf_dir):
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    own = lines(spark, sf_dir).select("l_orderkey", "l_partkey", "l_suppkey", point_key().alias("ord"))
    return own.join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))


KINDS = {"article": "l_orderkey", "film": "p_name", "substrate": "p_brand", "method": "n_name"}
EDGES = {"has_film": ("article", "l_orderkey", "film", "p_name"), "on": ("film", "p_name", "substrate", "p_brand"), "made_by": ("film", "p_name", "method", "n_name")}


def graph_nodes(spark, sf_dir):
    return graphs.nodes(supply(spark, sf_dir), {k: F.col(c) for k, c in KINDS.items()}, "ord")


def graph_edges(spark, sf_dir):
    return graphs.edges(supply(spark, sf_dir), {k: (s, F.col(a), t, F.col(b)) for k, (s, a, t, b) in EDGES.items()})


SUPPLY = "s as (select * from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)"
NODES_SQL = f"with {SUPPLY} " + " union all ".join(f"select '{k}:' || lower(trim({c}::varchar)) as node_id, '{k}' as node_type, min({c}::varchar) as label, count(*) as n_mentions from s group by 1" for k, c in KINDS.items())
EDGES_SQL = f"with {SUPPLY} " + " union all ".join(f"select '{s}:' || lower({a}::varchar) as source_id, '{t}:' || lower({b}) as target_id, '{k}' as edge_type, count(*) as weight from s group by 1, 2" for k, (s, a, t, b) in EDGES.items())


def graph_audit(spark, sf_dir):
    nodes = graph_nodes(spark, sf_dir).where("node_type <> 'method' or n_mentions % 2 = 0")
    return graphs.audit(nodes, graph_edges(spark, sf_dir))


AUDIT_SQL = f"""with n as (select * from ({NODES_SQL}) where node_type <> 'method' or n_mentions % 2 = 0), e as ({EDGES_SQL})
select (select count(*) from e where source_id not in (select node_id from n)) as orphan_sources, (select count(*) from e where target_id not in (select node_id from n)) as orphan_targets,
  (select count(*) from n where node_id not in (select source_id from e union select target_id from e)) as isolated_nodes, count(*) as n_edges, min(weight) as low, max(weight) as high from e"""


def phase_signature(spark, sf_dir):
    text = F.concat(F.lit('{"brand": "'), "p_brand", F.lit('", "size": '), F.col("p_size").cast("string"), F.lit(', "type": "'), "p_type", F.lit('"}'))
    return evidence.keep_one(read(spark, sf_dir, "part").withColumn("signature", F.sha1(text.cast("binary"))), ["signature"], [F.asc("p_partkey")]).select("p_partkey", "signature")


def fingerprint(spark, sf_dir):
    return recipes.fingerprint(read(spark, sf_dir, "part"), ["p_partkey", "p_name", "p_size"], "p_brand")


def formula_components(spark, sf_dir):
    f = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("Ni", "Si", "Co", "Pt")]), (F.col("p_partkey") % 4 + 1).cast("int")), F.when(F.col("p_size") % 5 > 1, (F.col("p_size") % 5).cast("string")).otherwise(F.lit("")), F.lit("Si2"))
    p = read(spark, sf_dir, "part").withColumn("formula", f)
    parts = F.transform(science.stoichiometry(F.col("formula")), lambda x: F.format_string("%s=%.1f", x["element"], x["ratio"]))
    return p.select("p_partkey", "formula", F.array_join(science.elements(F.col("formula")), ",").alias("elements"), F.array_join(parts, ",").alias("stoichiometry"), science.is_formula(F.col("formula")).alias("ok"))


FORMULA_SQL = """with f as (select p_partkey, ['Ni', 'Si', 'Co', 'Pt'][p_partkey % 4 + 1] as e, p_size % 5 as k from part)
select p_partkey, e || case when k > 1 then k::varchar else '' end || 'Si2' as formula, case when e = 'Si' then 'Si' else e || ',Si' end as elements, e || '=' || case when k > 1 then k else 1 end || '.0,Si=2.0' as stoichiometry, true as ok from f"""


def reference_scores(spark, sf_dir):
    """References scored against points' formulas, ranked within each point, with the interpretation of the best."""
    p = formula_components(spark, sf_dir).select("p_partkey", "formula")
    refs = spark.createDataFrame([("m1", "NiSi2", 0.0), ("m2", "Ni2Si2", 0.07), ("m3", "CoSi2", None), ("m4", "PtO", 0.3)], "material_id string, ref string, hull double")
    f = science.formula_match(F.col("formula"), F.col("ref"))
    s = p.join(F.broadcast(refs)).withColumn("formula_score", f).withColumn("score", science.reference_score(F.col("formula_score"), F.col("hull")))
    rank = F.row_number().over(Window.partitionBy("p_partkey").orderBy(F.desc(F.round("score", 9)), F.desc("formula_score"), "material_id"))
    return s.withColumn("rank", rank).select("p_partkey", "material_id", "rank", F.round("score", 6).alias("score"), science.interpretation(F.round("score", 9), F.col("formula_score"), F.lit(1)).alias("label"))


REFS_SQL = f"""with p as (select * from ({FORMULA_SQL})), r(material_id, ref, hull, el) as (values ('m1', 'NiSi2', 0.0, ['Ni', 'Si']), ('m2', 'Ni2Si2', 0.07, ['Ni', 'Si']), ('m3', 'CoSi2', null, ['Co', 'Si']), ('m4', 'PtO', 0.3, ['Pt', 'O'])),
f as (select *, case when formula = ref then 1 when list_sort(string_split(elements, ',')) = list_sort(el) then 0.85 when list_has_any(string_split(elements, ','), el) then 0.55 else 0 end::double as fs from p, r),
s as (select *, 0.5 * fs + 0.3 * case when fs = 1 then 1 when fs > 0 then 0.6 else 0 end + 0.2 * case when hull is null then 0 when hull <= 0.05 then 1 when hull <= 0.10 then 0.7 else 0.4 end as score from f)
select p_partkey, material_id, row_number() over (partition by p_partkey order by round(score, 9) desc, fs desc, material_id)::int as rank, round(score, 6)::double as score,
  case when round(score, 9) >= 0.70 then 'supports' when round(score, 9) <= 0.35 and fs < 0.40 then 'conflicts' else 'neutral' end as label from s"""


def lag_transitions(spark, sf_dir):
    return graphs.transitions(orders(spark, sf_dir), "o_custkey", [F.asc_nulls_last("o_orderdate"), F.asc("o_orderkey")], "o_orderstatus")


LAG_SQL = "with l as (select o_orderstatus as s, lag(o_orderstatus) over (partition by o_custkey order by o_orderdate nulls last, o_orderkey) as p from orders) select p as from_state, s as to_state, count(*) as n from l where p is not null and p <> s group by all"


def ndcg(spark, sf_dir):
    return recipes.ndcg(read(spark, sf_dir, "part").withColumn("rel", F.col("p_size") % 5), "p_brand", F.col("p_retailprice"), "rel", 10, "p_partkey").select("p_brand", F.round(F.col("ndcg") + 1e-9, 5).alias("ndcg"))


NDCG_SQL = """with r as (select p_brand, p_size % 5 as rel, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as i, row_number() over (partition by p_brand order by p_size % 5 desc, p_partkey) as j from part)
select p_brand, round(sum(case when i <= 10 then (pow(2.0::double, rel) - 1) / log2(i + 1) end) / sum(case when j <= 10 then (pow(2.0::double, rel) - 1) / log2(j + 1) end) + 1e-9, 5) as ndcg from r group by 1"""


def candidates(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    q = (F.col("p_size") % 11) / 10
    return recipes.scored(p, q, F.when(F.col("p_size") % 2 == 0, 1.0).otherwise(0.6), F.when(F.col("p_type") == "PROMO", 1.0).otherwise(0.65) - F.when(F.col("p_size") > 40, 0.25).otherwise(0.0), F.when(F.col("p_size") % 7 == 0, 0.08).otherwise(0.0), [F.col("p_partkey").cast("string"), F.lit("CVD"), F.lit("1")])


CAND = """c0 as (select *, (p_size % 11) / 10.0::double as q, case when p_size % 2 = 0 then 1 else 0.6 end::double as h, case when p_type = 'PROMO' then 1 else 0.65 end::double - case when p_size > 40 then 0.25 else 0 end as target, case when p_size % 7 = 0 then 0.08 else 0 end::double as bonus from part),
c1 as (select *, least(greatest(least(greatest(0.35 + 0.45 * q + 0.20 * h, 0), 1) + 0.5 * bonus, 0), 1) as evidence, least(greatest(least(greatest(0.30 + 0.40 * q + 0.30 * h, 0), 1) + 0.35 * bonus, 0), 1) as repro, 0.15 + 0.75 * (('0x' || substr(sha1(p_partkey || '|CVD|1'), 1, 4))::bigint / 65535.0::double) as novelty from c0),
c2 as (select *, 1 - (0.6 * evidence + 0.4 * repro) as uncertainty, least(greatest(0.45 * least(greatest(target, 0), 1) + 0.30 * evidence + 0.20 * repro + 0.05 * novelty + bonus, 0), 1) as weighted from c1),
c3 as (select *, round(evidence, 9) >= 0.35 and round(coalesce(nullif(uncertainty, 0), 1), 9) <= 0.45 as loose from c2),
c4 as (select *, loose and round(evidence, 9) >= 0.55 and round(coalesce(nullif(uncertainty, 0), 1), 9) <= 0.35 and round(repro, 9) >= 0.50 as balanced from c3),
c5 as (select *, balanced and round(evidence, 9) >= 0.70 and round(coalesce(nullif(uncertainty, 0), 1), 9) <= 0.25 and round(repro, 9) >= 0.65 as strict from c4)"""


def recipe_scores(spark, sf_dir):
    return candidates(spark, sf_dir).select("p_partkey", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("evidence", "uncertainty", "weighted")])


def recipe_rank(spark, sf_dir):
    return recipes.top(recipes.progressive(candidates(spark, sf_dir)).where("gate = 'strict'"), 10, "p_partkey").select("p_partkey", F.round(F.col("weighted") + 1e-9, 5).alias("weighted"))


def progressive_gate(spark, sf_dir):
    return recipes.progressive(candidates(spark, sf_dir)).groupBy("gate").agg(F.count(F.lit(1)).alias("n"))


def gate_audit(spark, sf_dir):
    return recipes.gate_audit(candidates(spark, sf_dir)).groupBy("stage", "passed", "reason").agg(F.count(F.lit(1)).alias("n"))


def safety_filter(spark, sf_dir):
    rules = [("forbidden_precursor", F.lower("p_name").contains("red")), ("temperature_above_limit", F.col("p_size") > 45), ("forbidden_method", F.col("p_type") == "LARGE")]
    return recipes.safety(read(spark, sf_dir, "part"), rules).groupBy("blocked_by", "safe").agg(F.count(F.lit(1)).alias("n"))


SAFETY_SQL = """select array_to_string(list_sort(list_filter([case when contains(lower(p_name), 'red') then 'forbidden_precursor' end, case when p_size > 45 then 'temperature_above_limit' end, case when p_type = 'LARGE' then 'forbidden_method' end], lambda x: x is not null)), ';') as blocked_by,
  not (contains(lower(p_name), 'red') or p_size > 45 or p_type = 'LARGE') as safe, count(*) as n from part group by all"""


def bucketers(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    v = F.col("c_acctbal")
    return c.select("c_custkey", science.bucket(v, science.TEMPERATURE).alias("temperature"), science.bucket(v, science.TIME).alias("time"), science.bucket(v * 10, science.PRESSURE).alias("pressure"), science.bucket(v / 20000, science.STABILITY).alias("stability"), science.bucket(v / 20000, science.HULL).alias("hull"), science.bandgap_bucket(F.round(v / 2000)).alias("bandgap"), science.crystal_system(F.pmod(F.col("c_custkey"), F.lit(231))).alias("crystal"))


BUCKET_SQL = """select c_custkey, case when v <= 0 then 'unknown_temperature_regime' when v < 200 then 'temp_regime_low' when v < 450 then 'temp_regime_mid' when v < 750 then 'temp_regime_high' else 'temp_regime_extreme' end as temperature,
  case when v <= 0 then 'unknown_time_regime' when v < 30 then 'time_regime_short' when v < 600 then 'time_regime_medium' when v < 3600 then 'time_regime_long' else 'time_regime_very_long' end as time,
  case when v <= 0 then 'unknown_pressure_regime' when v * 10 < 100 then 'pressure_regime_high_vacuum' when v * 10 < 10000 then 'pressure_regime_low_pressure' when v * 10 < 50000 then 'pressure_regime_mid_pressure' else 'pressure_regime_atm_like' end as pressure,
  case when v <= 0 then 'stability_unknown' when v / 20000 <= 0.05 then 'stability_stable' when v / 20000 <= 0.10 then 'stability_metastable' else 'stability_unstable' end as stability,
  case when v <= 0 then 'energy_hull_unknown' when v / 20000 <= 0.05 then 'energy_hull_0_0p05' when v / 20000 <= 0.10 then 'energy_hull_0p05_0p10' when v / 20000 <= 0.30 then 'energy_hull_0p10_0p30' else 'energy_hull_gt_0p30' end as hull,
  case when round(v / 2000) < 0 then 'bandgap_unknown' when round(v / 2000) = 0 then 'bandgap_metallic' when round(v / 2000) < 1 then 'bandgap_narrow' when round(v / 2000) < 3 then 'bandgap_mid' else 'bandgap_wide' end as bandgap,
  case when k <= 2 then 'triclinic' when k <= 15 then 'monoclinic' when k <= 74 then 'orthorhombic' when k <= 142 then 'tetragonal' when k <= 167 then 'trigonal' when k <= 194 then 'hexagonal' else 'cubic' end as crystal
from (select *, c_acctbal as v, c_custkey % 231 as k from customer)"""


def text_quantities(spark, sf_dir):
    t = F.concat(F.lit("annealed for "), F.col("p_size").cast("string"), F.element_at(F.array(F.lit(" min"), F.lit(" h"), F.lit(" seconds")), (F.col("p_partkey") % 3 + 1).cast("int")), F.lit(" at "), F.col("p_size").cast("string"), F.lit(" torr, strain -0."), F.col("p_size").cast("string"), F.lit(" %, vacancies "), F.col("p_size").cast("string"), F.lit(" cm-3"))
    return read(spark, sf_dir, "part").select("p_partkey", science.seconds_in(t).alias("seconds"), F.round(science.pascals_in(t), 4).alias("pascals"), science.strain_in(t).alias("strain"), science.vacancies_in(t).alias("vacancies"))


QUANT_SQL = "select p_partkey, p_size * [60.0, 3600.0, 1.0][p_partkey % 3 + 1]::double as seconds, round(p_size * 133.322::double, 4) as pascals, ('-0.' || p_size)::double as strain, p_size::double as vacancies from part"


def snippet_labels(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in ("sputtered smooth layer", "ALD, rough surface", "chemical vapor, epitaxial", "rapid thermal step", "plain text")])
    t = F.get(words, (F.col("p_partkey") % 5).cast("int"))
    return read(spark, sf_dir, "part").groupBy(science.quality_label(t).alias("quality"), science.method_family(t).alias("method")).agg(F.count(F.lit(1)).alias("n"))


LABELS_SQL = "select ['uniform', 'degraded', 'high_crystallinity', 'unknown', 'unknown'][p_partkey % 5 + 1] as quality, ['PVD', 'ALD', 'CVD', 'ANNEAL', ''][p_partkey % 5 + 1] as method, count(*) as n from part group by all"


def label_mode(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").groupBy(F.pmod("vec_id", F.lit(7)).alias("bucket")).agg(F.mode("label", True).alias("mode_label"))


def pair_completeness(spark, sf_dir):
    has = lambda f: F.max(F.when(F.col("l_returnflag") == f, 1).otherwise(0))
    per = lines(spark, sf_dir).groupBy("l_orderkey").agg(has("A").alias("a"), has("N").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("points"), F.round(F.avg(F.col("a") * F.col("n")), 6).alias("pair_completeness"))


def source_agreement(spark, sf_dir):
    """Pairs of sources of one item: how many agree within tolerance. Per item the sources' means are few; their pairs are made inside the item's array."""
    per = lines(spark, sf_dir).groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("q"))
    item = per.groupBy("l_partkey").agg(F.sort_array(F.collect_list("q")).alias("qs")).where(F.size("qs") >= 2)
    agree = F.aggregate(F.transform("qs", lambda a, i: F.size(F.filter(F.slice(F.col("qs"), i + 2, F.size("qs")), lambda b: F.abs(a - b) <= 10))), F.lit(0), lambda s, x: s + x)
    return item.select("l_partkey", (F.size("qs") * (F.size("qs") - 1) / 2).cast("long").alias("pairs"), agree.cast("long").alias("agreeing"))


AGREE_SQL = """with p as (select l_partkey, l_suppkey, avg(l_quantity) as q from lineitem group by all)
select a.l_partkey, count(*) as pairs, count(*) filter (abs(a.q - b.q) <= 10) as agreeing from p a join p b on a.l_partkey = b.l_partkey and a.l_suppkey < b.l_suppkey group by 1"""


def quality_gates(spark, sf_dir):
    p = lines(spark, sf_dir)
    m = p.agg(F.avg((F.col("l_tax") < 0.06).cast("double")).alias("usable"), F.percentile("l_discount", 0.75).alias("p75"), F.median("l_quantity").alias("median_support"), F.avg((F.col("l_returnflag") == "R").cast("double")).alias("timeout_rate"))
    return m.select(F.round("usable", 6).alias("usable"), F.round("p75", 6).alias("p75"), "median_support", ((F.round("usable", 9) >= 0.70) & (F.col("p75") <= 1.0) & (F.col("median_support") >= 3) & (F.round("timeout_rate", 9) <= 0.25)).alias("passed"))


GATES_SQL = "select round(avg((l_tax < 0.06)::int), 6) as usable, round(quantile_cont(l_discount, 0.75), 6) as p75, median(l_quantity) as median_support, round(avg((l_tax < 0.06)::int), 9) >= 0.70 and quantile_cont(l_discount, 0.75) <= 1 and median(l_quantity) >= 3 and round(avg((l_returnflag = 'R')::int), 9) <= 0.25 as passed from lineitem"


def link_diff(spark, sf_dir):
    o = orders(spark, sf_dir)
    edge = lambda t: t.select("o_custkey", "o_orderpriority").distinct()
    return recipes.link_difference(edge(o.where("year(o_orderdate) >= 1997")), edge(o.where("year(o_orderdate) < 1997")), ["o_custkey", "o_orderpriority"])


LINK_SQL = """with n as (select distinct o_custkey, o_orderpriority from orders where year(o_orderdate) >= 1997), o as (select distinct o_custkey, o_orderpriority from orders where year(o_orderdate) < 1997)
select *, 'added' as change from (from n except from o) union all select *, 'removed' from (from o except from n)"""


def drift_compare(spark, sf_dir):
    n = lambda y: orders(spark, sf_dir).where(F.year("o_orderdate") == y).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return recipes.drift(n(1996), n(1997), "o_orderpriority", "n", 0.02).withColumn("drift", F.round("drift", 6))


DRIFT_SQL = "with c as (select o_orderpriority, count(*) filter (year(o_orderdate) = 1996) as before, count(*) filter (year(o_orderdate) = 1997) as after from orders group by 1) select o_orderpriority, before, after, round(abs(after - before) / greatest(abs(before), 1), 6) as drift, round(abs(after - before) / greatest(abs(before), 1), 9) <= 0.02 as ok from c"


def hash_split(spark, sf_dir):
    train, test = models.split(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))


def oversample(spark, sf_dir):
    return recipes.oversample(read(spark, sf_dir, "part").select("p_brand", "p_size"), F.col("p_size") > 40, 2).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


def numeric_means(spark, sf_dir):
    return lines(spark, sf_dir).groupBy("l_orderkey").agg(F.round(F.avg("l_quantity") + 1e-9, 5).alias("quantity"), F.size(F.collect_set("l_returnflag")).cast("long").alias("n_flags"))


def value_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source")


def grouped(form):
    def run(spark, sf_dir):
        return getattr(lines(spark, sf_dir), form)("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))

    return run


def grouping_sets(spark, sf_dir):
    lines(spark, sf_dir).createOrReplaceTempView("veinstone_lines")
    return spark.sql("select l_returnflag, l_linestatus, count(*) as n from veinstone_lines group by grouping sets ((l_returnflag), (l_linestatus), ())")


def approx_distinct(spark, sf_dir):
    """Distinct parts of each flag by a sketch, rounded to what the sketch can tell: the bit length of the number."""
    return lines(spark, sf_dir).groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.01).alias("n")).select("l_returnflag", F.round(F.log2("n"), 0).alias("log2_parts"))


REGISTRY = {
    "nearest_context": (nearest_context, NEAREST_CONTEXT_SQL),
    "window_assemble": (window_assemble, ASSEMBLE_SQL),
    "rank_zip": (rank_zip, RANKZIP_SQL),
    "as_of": (as_of, "select p.event_id, v.value as last_view from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts"),
    "tolerance_candidates": (tolerance_candidates, f"with {GOLD} select entity, count(*) as n, count(distinct k) as n_pred, count(distinct gold_id) as n_gold from p join g using (entity) where abs(p.x - gx) <= 2 and abs(p.y - gy) <= 8 group by 1"),
    "tolerance_match": (tolerance_match, None),
    "match_scores": (match_scores, None),
    "nearest_gold": (nearest_gold, NEAREST_SQL),
    "cross_models": (cross_models, "select r_name, n_name from region, nation"),
    "cooccurrence_pairs": (cooccurrence_pairs, COOC_SQL),
    "cross_source_support": (cross_source_support, "select l_partkey, round(least(1.0, count(distinct l_suppkey) / 3), 6)::double as support from lineitem group by 1"),
    "frequency_features": (frequency_features, FREQ_SQL),
    "bridge_weight": (bridge_weight, BRIDGE + " select t as concept_type, round(w, 9) >= 0.69 as kept, count(*) as n, round(avg(w), 6) as mean_weight from b group by all"),
    "bridge_stats": (bridge_stats, BRIDGE + " select id as source_point_id, count(*) as n_bridges, round(avg(w) + 1e-9, 5) as mean_weight, round(max(w), 6) as max_weight, round(count(distinct t) / 7, 6) as coverage from b where round(w, 9) >= 0.69 group by 1"),
    "graph_nodes": (graph_nodes, NODES_SQL),
    "graph_edges": (graph_edges, EDGES_SQL),
    "graph_audit": (graph_audit, AUDIT_SQL),
    "phase_signature": (phase_signature, """select min(p_partkey) as p_partkey, sha1('{"brand": "' || p_brand || '", "size": ' || p_size || ', "type": "' || p_type || '"}') as signature from part group by 2"""),
    "fingerprint": (fingerprint, "select p_brand, sha1(count(*) || '|' || sum(('0x' || substr(h, 1, 15))::hugeint) || '|' || sum(('0x' || substr(h, 16, 15))::hugeint)) as fingerprint from (select p_brand, sha1(p_partkey || '|' || p_name || '|' || p_size) as h from part) group by 1"),
    "formula_components": (formula_components, FORMULA_SQL),
    "reference_scores": (reference_scores, REFS_SQL),
    "lag_transitions": (lag_transitions, LAG_SQL),
    "ndcg": (ndcg, NDCG_SQL),
    "recipe_scores": (recipe_scores, f"with {CAND} select p_partkey, round(evidence + 1e-9, 5) as evidence, round(uncertainty + 1e-9, 5) as uncertainty, round(weighted + 1e-9, 5) as weighted from c2"),
    "recipe_rank": (recipe_rank, f"with {CAND} select p_partkey, round(weighted + 1e-9, 5) as weighted from c5 where strict order by round(weighted, 6) desc, round(target, 6) desc, round(evidence, 6) desc, round(repro, 6) desc, p_partkey limit 10"),
    "progressive_gate": (progressive_gate, f"with {CAND} select case when strict then 'strict' when balanced then 'balanced' when loose then 'loose' else 'none' end as gate, count(*) as n from c5 group by 1"),
    "gate_audit": (gate_audit, f"""with {CAND}, u as (select *, round(evidence, 9) as e, round(repro, 9) as rp, round(coalesce(nullif(uncertainty, 0), 1), 9) as un from c5),
        s as (select 'loose' as stage, concat_ws(';', case when e < 0.35 then 'low_evidence_support' end, case when un > 0.45 then 'high_uncertainty' end) as reason from u union all
        select 'balanced', concat_ws(';', case when e < 0.55 then 'low_evidence_support' end, case when rp < 0.50 then 'low_reproducibility' end, case when un > 0.35 then 'high_uncertainty' end) from u where loose union all
        select 'strict', concat_ws(';', case when e < 0.70 then 'low_evidence_support' end, case when rp < 0.65 then 'low_reproducibility' end, case when un > 0.25 then 'high_uncertainty' end) from u where balanced)
        select stage, reason = '' as passed, reason, count(*) as n from s group by all"""),
    "safety_filter": (safety_filter, SAFETY_SQL),
    "bucketers": (bucketers, BUCKET_SQL),
    "text_quantities": (text_quantities, QUANT_SQL),
    "snippet_labels": (snippet_labels, LABELS_SQL),
    "label_mode": (label_mode, "with c as (select vec_id % 7 as bucket, label, count(*) as n from embeddings group by all) select bucket, arg_min(label, row(-n, label)) as mode_label from c group by 1"),
    "pair_completeness": (pair_completeness, "with p as (select l_orderkey, max((l_returnflag = 'A')::int) * max((l_returnflag = 'N')::int) as ok from lineitem group by 1) select count(*) as points, round(avg(ok), 6) as pair_completeness from p"),
    "source_agreement": (source_agreement, AGREE_SQL),
    "quality_gates": (quality_gates, GATES_SQL),
    "link_diff": (link_diff, LINK_SQL),
    "drift_compare": (drift_compare, DRIFT_SQL),
    "hash_split": (hash_split, "select doc_id, case when ('0x' || substr(md5('0:' || doc_id), 1, 8))::bigint % 100 < 80 then 'train' else 'test' end as split from documents"),
    "oversample": (oversample, "select p_brand, count(*) + 2 * count(*) filter (p_size > 40) as n from part group by 1"),
    "numeric_means": (numeric_means, "select l_orderkey, round(avg(l_quantity) + 1e-9, 5) as quantity, count(distinct l_returnflag) as n_flags from lineitem group by 1"),
    "value_counts": (value_counts, "select source, count(*) as n from documents group by 1"),
    "rollup": (grouped("rollup"), "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem group by rollup (l_returnflag, l_linestatus)"),
    "cube": (grouped("cube"), "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem group by cube (l_returnflag, l_linestatus)"),
    "grouping_sets": (grouping_sets, "select l_returnflag, l_linestatus, count(*) as n from lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())"),
    "approx_distinct": (approx_distinct, "select l_returnflag, round(log2(count(distinct l_partkey)), 0) as log2_parts from lineitem group by 1"),
}
