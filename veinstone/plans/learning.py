"""Queries of sources and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from veinstone.operators import models
from veinstone.plans.evidence import read
from veinstone.sources import files, providers


def catalogue_articles(spark, sf_dir):
    """Catalogue records made of parts, read back through the providers' mapping."""
    p = read(spark, sf_dir, "part")
    oa = F.to_json(F.struct(F.concat(F.lit("W"), "p_partkey").alias("id"), F.col("p_name").alias("title"), (1950 + F.col("p_size")).alias("publication_year"), F.lit("article").alias("type"), F.struct((F.col("p_size") % 2 == 0).alias("is_oa"), F.lit("https://oa/x.pdf").alias("oa_url")).alias("open_access"), F.create_map(F.col("p_type"), F.array(F.lit(1)), F.lit("The"), F.array(F.lit(0))).alias("abstract_inverted_index")))
    return providers.articles(p.select(oa.alias("raw_json")), "openalex", oa_required=True).select("source_id", "title", "abstract", "year", "article_type", "oa_url", "article_key")


ARTICLES_SQL = "select 'W' || p_partkey as source_id, p_name as title, 'The ' || p_type as abstract, 1950 + p_size as year, 'journal-article' as article_type, 'https://oa/x.pdf' as oa_url, substr(sha1('W' || p_partkey), 1, 16) as article_key from part where p_size % 2 = 0"


def file_scan(spark, sf_dir):
    """The tables' files by title, with the rows that each holds."""
    names = ("nation.parquet", "region.parquet")
    found = files.scan(spark, sf_dir, "{nation,region}.parquet", recursive=False)
    sizes = [files.table(spark, f"{sf_dir}/{n}").agg(F.lit(n.removesuffix(".parquet")).alias("title"), F.count(F.lit(1)).alias("n_rows")) for n in names]
    return found.select("title", (F.col("length") > 0).alias("filled")).join(sizes[0].union(sizes[1]), "title")


NUMERIC, CATEGORICAL = ["l_quantity", "l_tax", "l_discount"], ["l_linestatus"]


def tabular_head(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumn("quality", 1 - F.col("l_discount") * 5)
    train, test = models.split(rows, "l_orderkey")
    model = models.train(train, "l_returnflag", "quality", NUMERIC, CATEGORICAL, trees=5)
    return models.predict(model, test, NUMERIC, CATEGORICAL).select("l_orderkey", "l_linenumber", "predicted_label", "phase_prob", "quality", "uncertainty")


REGISTRY = {
    "catalogue_articles": (catalogue_articles, ARTICLES_SQL),
    "file_scan": (file_scan, "select 'nation' as title, true as filled, count(*) as n_rows from nation union all select 'region', true, count(*) from region"),
    "tabular_head": (tabular_head, None),
}
