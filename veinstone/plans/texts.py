"""Queries that extract from text; each document gets sentences of known content beside its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinstone.operators import extraction
from veinstone.plans.evidence import read

SPEC = extraction.Spec(
    (extraction.Variable("thickness_nm", ("thickness", "film thickness"), "nm", 0, 5000), extraction.Variable("temperature_c", ("temperature", "annealing temperature"), "c", 20, 1400)),
    {"Ni2Si": (), "NiSi": (), "NiSi2": ()},
)


def measured(spark, sf_dir):
    """Parts as articles that report a thickness and a temperature."""
    t = F.format_string("NiSi forms at thickness %d nm. Then temperature %d C was held. Nothing else.\n", F.col("p_size"), F.col("p_size") * 10 + 20)
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("article_key"), t.alias("text"))


def extract_values(spark, sf_dir):
    return extraction.extract(measured(spark, sf_dir), SPEC, ("text",)).select("article_key", "variable_name", "normalized_value", "entity", "locator")


EXTRACT_SQL = """with w(n, locator, entity) as (values ('thickness_nm', 'sentence:1', 'NiSi'), ('temperature_c', 'sentence:1', 'NiSi'), ('thickness_nm', 'sentence:2', 'NiSi'), ('temperature_c', 'sentence:2', 'NiSi'), ('temperature_c', 'sentence:3', ''))
select p_partkey::varchar as article_key, n as variable_name, case n when 'thickness_nm' then p_size else p_size * 10 + 20 end::double as normalized_value, entity, locator from part, w"""


def pair_values(spark, sf_dir):
    """Values of phrases without the variables' names."""
    t = F.format_string("For %d nm films the phase was seen at %d C there. NiSi2 forms near 520 C.", F.col("p_size"), F.col("p_size") + 300)
    docs = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("article_key"), t.alias("text"))
    return extraction.extract(docs, SPEC, ("text",)).groupBy("article_key", "variable_name", "normalized_value").agg(F.count(F.lit(1)).alias("n"))


PAIR_SQL = """select p_partkey::varchar as article_key, unnest(['thickness_nm', 'temperature_c']) as variable_name, unnest([p_size, p_size + 300])::double as normalized_value, 2 as n from part"""


def salvaged_pairs(spark, sf_dir):
    """Pairs out of texts that a model gave no answer for."""
    return extraction.salvaged(measured(spark, sf_dir), SPEC, "article_key").select("chunk_id", "entity", "x", "y", "locator", "confidence")


SALVAGE_SQL = "select p_partkey::varchar as chunk_id, 'NiSi' as entity, p_size::double as x, (p_size * 10 + 20)::double as y, 'chunk-salvage:sentence:1' as locator, 0.78::double as confidence from part"


def transition_events(spark, sf_dir):
    t = F.format_string("For %d-%d nm Ni films, Ni2Si appears at 250-270 C, NiSi appears at %d C, and NiSi2 appears near 510-530 C.", F.col("p_size"), F.col("p_size") + 10, F.col("p_size") + 330)
    docs = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("article_key"), t.alias("text"))
    return extraction.extract(docs, SPEC, ("transition",)).select("article_key", "variable_name", "normalized_value", "entity")


TRANSITION_SQL = """with e as (select p_partkey, p_size, unnest([{'e': 'Ni2Si', 't': 260.0}, {'e': 'NiSi', 't': p_size + 330.0}, {'e': 'NiSi2', 't': 520.0}]) as x from part)
select p_partkey::varchar as article_key, 'thickness_nm' as variable_name, (p_size + 5)::double as normalized_value, x.e as entity from e union all select p_partkey::varchar, 'temperature_c', x.t::double, x.e from e"""


def document_coverage(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_key"), "text")
    return extraction.coverage(docs, extraction.extract(docs, SPEC)).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


REGISTRY = {
    "extract_values": (extract_values, EXTRACT_SQL),
    "pair_values": (pair_values, PAIR_SQL),
    "salvaged_pairs": (salvaged_pairs, SALVAGE_SQL),
    "transition_events": (transition_events, TRANSITION_SQL),
    "document_coverage": (document_coverage, None),
}
