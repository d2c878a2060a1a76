"""Queries of acquisition, notes, model replies and material context."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinstone.operators import acquisition, context, graphs, language_models, notes
from veinstone.plans.evidence import read
from veinstone.plans.relations import graph_nodes


def offline(url: str) -> tuple[int, str, bytes]:
    """A client that answers from the URL itself."""
    if "/de/" in url:
        return 404, "", b""
    if "/es/" in url:
        raise ConnectionError(url)
    return 200, "text/html", url.encode()


def candidates(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    urls = F.array(F.col("url"), F.concat(F.lit("https://mirror.example.org/x/"), "page_id"))
    return p.select(F.col("page_id").cast("string").alias("article_key"), F.posexplode(urls).alias("candidate_rank", "url"))


def fetch_first_success(spark, sf_dir):
    results = acquisition.fetch(candidates(spark, sf_dir), "veinstone.plans.materials:offline", delay=0.0, retries=0, lanes=4)
    return acquisition.first_success(results).select("article_key", "candidate_rank", "ok", "attempts")


FETCH_SQL = "select page_id::varchar as article_key, case when contains(url, '/de/') or contains(url, '/es/') then 1 else 0 end::int as candidate_rank, true as ok, 2 as attempts from pages"


def resume_pending(spark, sf_dir):
    progress = read(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("article_key"), F.when(F.col("page_id") % 3 == 0, "success").otherwise("failed").alias("status"))
    return acquisition.pending(candidates(spark, sf_dir).where("candidate_rank = 0"), progress, [F.length("article_key"), F.asc("article_key")], 20).select("article_key")


def note_links(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    md = notes.export(o.withColumn("target", F.concat(F.lit("order-"), "o_orderkey")), "o_custkey", "o_orderstatus", "target", "o_orderkey")
    return notes.links(md, "o_custkey", "markdown").select("o_custkey", "heading", "target")


def note_supervision(spark, sf_dir):
    hints = note_links(spark, sf_dir).withColumns({"sign": F.when(F.col("heading") == "F", -1).otherwise(1), "w": F.lit(0.5)})
    return notes.supervision(hints, "o_custkey", "sign", "w")


def reply_tuples(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    body = F.format_string('{"entity": "%s", "x": %d, "y": %d.5, "confidence": 0.9}', F.col("p_type"), F.col("p_size"), F.col("p_size"))
    kinds = F.array(F.concat(F.lit("["), body, F.lit("]")), F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```")), F.concat(F.lit("Here it is "), body, F.lit(" done")), F.lit("no result"))
    reply = F.get(kinds, (F.col("p_partkey") % 4).cast("int"))
    return p.select("p_partkey", F.explode(language_models.tuples(reply)).alias("t")).select("p_partkey", "t.entity", "t.x", "t.y")


def context_merge(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    c = p.select("p_brand", F.col("p_size").alias("score"), F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.lit(" ")).alias("substrate"))
    doc = context.document_context(c, "p_brand", ["substrate"])
    return p.join(doc.withColumnRenamed("substrate", "_doc").drop("score"), "p_brand").select("p_partkey", context.merged(F.when(F.col("p_size") % 3 == 0, F.col("p_name")), F.col("_doc")).alias("substrate"))


CONTEXT_SQL = """with d as (select p_brand, arg_min(p_type, row(-p_size, p_partkey)) as s from part where p_partkey % 2 = 0 group by 1)
select p_partkey, case when p_size % 3 = 0 then p_name else coalesce(s, '') end as substrate from part left join d using (p_brand)"""


def reference_records(spark, sf_dir):
    body = F.format_string('{"material_id": "m%d", "formula_pretty": "NiSi", "energy_above_hull": 0.0, "symmetry": {"symbol": "Pnma", "number": %d}}', F.col("p_partkey"), F.col("p_size") * 4)
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('{"data": ['), body, F.lit("]}"))).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    return context.references(read(spark, sf_dir, "part").select(raw.alias("raw_json"))).groupBy("crystal_system", "space_group").agg(F.count(F.lit(1)).alias("n"))


REFERENCE_SQL = "select case when k <= 2 then 'triclinic' when k <= 15 then 'monoclinic' when k <= 74 then 'orthorhombic' when k <= 142 then 'tetragonal' when k <= 167 then 'trigonal' when k <= 194 then 'hexagonal' else 'cubic' end as crystal_system, 'Pnma' as space_group, count(*) as n from (select p_size * 4 as k from part) group by 1"


def ontology_seed(spark, sf_dir):
    """The orders' years as space groups, with what the ontology says of them, and the size of each vocabulary."""
    seeds = context.ontology(spark)
    used = read(spark, sf_dir, "orders").select(F.concat(F.lit("sg"), F.year("o_orderdate") - 1900).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    links = context.ontology_links(spark).select(F.col("source_key").alias("key"), F.col("target_key").alias("crystal_system"))
    named = used.join(seeds.where("concept_type = 'space_group'"), "key").join(links, "key").select("concept_type", "label", "crystal_system", "n")
    return named.union(seeds.groupBy("concept_type").agg(F.count(F.lit(1)).alias("n")).select("concept_type", F.lit("").alias("label"), F.lit("").alias("crystal_system"), "n"))


def dense_node_ids(spark, sf_dir):
    ids = context.dense_ids(graph_nodes(spark, sf_dir), "node_type", "node_id")
    return ids.groupBy("node_type").agg(F.count(F.lit(1)).alias("n"), F.min("index").alias("low"), F.max("index").alias("high"), F.countDistinct("index").alias("n_index"))


def thickness_posterior(spark, sf_dir):
    c = F.array(F.lit(1.0), (F.col("p_size") % 3).cast("double"))
    out = context.annealed_thickness(F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("double")), F.lit(10.0), c, F.when(F.col("p_size") % 5 == 0, 8.0), F.lit(0.1), F.lit(0.8), F.lit(0.4))
    return read(spark, sf_dir, "part").select("p_partkey", F.round(out + 1e-9, 5).alias("thickness"))


THICKNESS_SQL = """with p as (select *, 10.0::double * (1 + p_size % 3) * case when p_size % 5 = 0 then 1 else 1.0 end as prior from part)
select p_partkey, round(case when p_size % 2 = 0 then (0.40 + 0.35 * 0.8 + 0.25 * 0.4) * p_size + (1 - (0.40 + 0.35 * 0.8 + 0.25 * 0.4)) * prior else prior end::double + 1e-9, 5) as thickness from p"""


def article_type_counts(spark, sf_dir):
    """Histogram of node types by article, as sorted JSON."""
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    n = rows.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("o_custkey").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("o_orderstatus", "n"))))).alias("counts"))


REGISTRY = {
    "fetch_first_success": (fetch_first_success, FETCH_SQL),
    "resume_pending": (resume_pending, "select page_id::varchar as article_key from pages where page_id % 3 > 0 order by length(page_id::varchar), page_id::varchar limit 20"),
    "note_links": (note_links, "select o_custkey, o_orderstatus as heading, 'order-' || o_orderkey as target from orders"),
    "note_supervision": (note_supervision, "select o_custkey, sum(case when o_orderstatus = 'F' then -0.5 else 0.5 end)::double as score, count(*) filter (o_orderstatus <> 'F') as n_for, count(*) filter (o_orderstatus = 'F') as n_against from orders group by 1"),
    "reply_tuples": (reply_tuples, "select p_partkey, p_type as entity, p_size::double as x, p_size + 0.5::double as y from part where p_partkey % 4 < 3"),
    "context_merge": (context_merge, CONTEXT_SQL),
    "reference_records": (reference_records, REFERENCE_SQL),
    "ontology_seed": (ontology_seed, """with y as (select year(o_orderdate) - 1900 as k, count(*) as n from orders group by 1)
        select 'space_group' as concept_type, 'SG' || k as label, case when k <= 2 then 'triclinic' when k <= 15 then 'monoclinic' when k <= 74 then 'orthorhombic' when k <= 142 then 'tetragonal' when k <= 167 then 'trigonal' when k <= 194 then 'hexagonal' else 'cubic' end as crystal_system, n from y union all
        select concept_type, '', '', n from (values ('element', 118), ('dopant_element', 118), ('alloy_element', 118), ('space_group', 230), ('crystal_system', 8), ('orientation_family', 11), ('method_family', 16), ('ambient_gas', 10), ('temperature_regime', 5), ('time_regime', 5), ('pressure_regime', 5),
        ('stability_band', 4), ('energy_hull_bucket', 5), ('bandgap_bucket', 5), ('metallicity_class', 3), ('magnetic_class', 5), ('substrate_material', 1), ('precursor_chemistry', 1), ('prototype_family', 1), ('quality_metric_type', 1), ('defect_metric_type', 2), ('interface_state_type', 1)) t(concept_type, n)"""),
    "dense_node_ids": (dense_node_ids, "with n as (select 'article' as node_type, count(distinct l_orderkey) as c from lineitem union all select 'film', count(distinct p_name) from lineitem join part on l_partkey = p_partkey union all select 'substrate', count(distinct p_brand) from lineitem join part on l_partkey = p_partkey union all select 'method', count(distinct n_name) from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey) select node_type, c as n, 0 as low, c - 1 as high, c as n_index from n"),
    "thickness_posterior": (thickness_posterior, THICKNESS_SQL),
    "article_type_counts": (article_type_counts, """with c as (select o_custkey, o_orderstatus as s, count(*) as n from orders group by all) select o_custkey, '{' || string_agg('"' || s || '":' || n, ',' order by s) || '}' as counts from c group by 1"""),
}
