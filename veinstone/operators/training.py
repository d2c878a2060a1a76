"""Training rows of the processor: joined features, splits, slices, embeddings and models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions import science
from veinstone.functions.text import blank
from veinstone.operators import models
from veinstone.operators.evidence import keep_one
from veinstone.operators.validation import text_of

#: The processor's features.
NUMERIC = "thickness_nm anneal_temperature_c anneal_time_s pressure_pa strain_pct composition_value vacancy_concentration_cm3 film_quality_score_numeric mp_interpretation_score mp_formula_match_score mp_phase_match_score mp_stability_score mp_energy_above_hull_min concept_bridge_count concept_bridge_mean_weight concept_bridge_max_weight concept_gate_coverage".split()
CATEGORICAL = "phase_label film_material phase_signature substrate_material substrate_orientation method_family doping_state alloy_state mp_interpretation_label mp_spacegroup_symbol spacegroup_symbol".split()
#: Reference features that replace those of the rows.
REFERENCE = "mp_interpretation_score mp_formula_match_score mp_phase_match_score mp_stability_score mp_energy_above_hull_min mp_interpretation_label mp_spacegroup_symbol".split()


def replaced(rows: DataFrame, features: DataFrame, names: list[str], key: str, order: str) -> DataFrame:
    """rows with the named columns of features in place of their own: one feature row a key, the first by order, so that rows never multiply."""
    own = [c for c in names if c in features.columns]
    one = keep_one(features.select(key, order, *own) if order != key else features.select(key, *own), [key], [F.asc(order)]).select(key, *own)
    return rows.drop(*own).join(one, key, "left")


def with_auxiliary(rows: DataFrame, auxiliary: DataFrame, key: str, order: str) -> DataFrame:
    """rows with the columns of auxiliary that begin with aux_."""
    return replaced(rows, auxiliary, [c for c in auxiliary.columns if c.startswith("aux_")], key, order)


def filled_features(rows: DataFrame) -> DataFrame:
    """rows with all features: numbers 0 and texts blank where they are absent or missing."""
    number = lambda c: F.coalesce(F.when(~F.isnan(F.col(c).try_cast("double")), F.col(c).try_cast("double")), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
    out = rows.withColumns({c: number(c) for c in NUMERIC} | {c: text_of(rows, c) for c in CATEGORICAL})
    return out.withColumn("phase_label", F.coalesce(F.nullif("phase_label", F.lit("")), F.lit("unknown")))


def phase_signature(formula: Column, symbol: Column, number: Column) -> Column:
    """SHA-1 of the canonical JSON of formula, space group and stoichiometry, by sorted keys and elements."""
    parts = F.transform(F.array_sort(science.stoichiometry(formula)), lambda x: F.concat(F.lit('{"element": "'), x["element"], F.lit('", "ratio": '), x["ratio"].cast("string"), F.lit("}")))
    body = F.concat(F.lit('{"reduced_formula": "'), formula, F.lit('", "spacegroup_number": "'), number, F.lit('", "spacegroup_symbol": "'), symbol, F.lit('", "stoich": ['), F.array_join(parts, ", "), F.lit("]}"))
    return F.sha1(body.cast("binary"))


def phase_id(signature: Column) -> Column:
    return F.concat(F.lit("phase_"), F.substring(F.sha1(signature.cast("binary")), 1, 16))


def signed(rows: DataFrame) -> DataFrame:
    """rows with reduced_formula, spacegroup_symbol, spacegroup_number and phase_signature."""
    formula, symbol, number = science.reduced_formula(text_of(rows, "film_material", "phase_label")), science.spacegroup_symbol(text_of(rows, "mp_spacegroup_symbol")), science.spacegroup_number(text_of(rows, "mp_spacegroup_number"))
    return rows.withColumns({"reduced_formula": formula, "spacegroup_symbol": symbol, "spacegroup_number": number, "phase_signature": phase_signature(formula, symbol, number)})


def phase_specs(rows: DataFrame) -> DataFrame:
    """One specification per phase signature."""
    one = signed(rows).groupBy("phase_signature").agg(F.first("reduced_formula").alias("reduced_formula"), F.first("spacegroup_symbol").alias("spacegroup_symbol"), F.first("spacegroup_number").alias("spacegroup_number"))
    return one.withColumns({"phase_id": phase_id(F.col("phase_signature")), "elements_json": F.to_json(science.elements(F.col("reduced_formula"))), "stoichiometry_json": F.to_json(science.stoichiometry(F.col("reduced_formula")))})


def with_phase(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """rows with the phase_id of their signature's specification, else one made of the signature."""
    found = specs.select(F.col("phase_signature").alias("_s"), F.col("phase_id").alias("_id"))
    own = signed(rows)
    return own.join(found, own["phase_signature"] == found["_s"], "left").withColumn("phase_id", F.coalesce("_id", phase_id(F.col("phase_signature")))).drop("_s", "_id")


def with_embeddings(rows: DataFrame, embeddings: DataFrame, key: str = "article_key", vector: str = "embedding", dimensions: int = 16) -> DataFrame:
    """rows with gnn_0, gnn_1, … of their article's vector; zeros without one."""
    one = keep_one(embeddings.select(key, vector), [key], [F.asc(vector)])
    out = rows.join(one.withColumnRenamed(vector, "_v"), key, "left")
    return out.withColumns({f"gnn_{k}": F.coalesce(F.get("_v", F.lit(k)).cast("double"), F.lit(0.0)) for k in range(dimensions)}).drop("_v")


def hash_embedding(tokens: DataFrame, token: str, dimensions: int = 16, seed: int = 0) -> DataFrame:
    """tokens with embedding: normal numbers of a generator seeded by the token's SHA-1, the same everywhere."""
    import hashlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seeds = [int(hashlib.sha1(f"{seed}|{t}".encode()).hexdigest()[:8], 16) for t in batch[token]]
            yield pd.DataFrame({token: batch[token], "embedding": [np.random.default_rng(x).normal(0.0, 1.0, dimensions).astype(np.float32) for x in seeds]})

    return tokens.select(F.col(token).cast("string").alias(token)).mapInPandas(run, f"{token} string, embedding array<float>")


def finetune_slice(rows: DataFrame, phase: str, thickest: float, substrates: list[str] | None = None, dopants: list[str] | None = None) -> DataFrame:
    """Rows of one phase up to a thickness, on some substrates and with some dopants if they are named."""
    import re

    out = rows.where((F.lower(F.trim(blank(F.col("phase_label")))) == phase.strip().lower()) & (F.coalesce("thickness_nm", F.lit(0.0)) <= thickest))
    if substrates:
        out = out.where(F.lower(blank(F.col("substrate_material"))).isin(*[s.lower() for s in substrates]))
    return out.where(F.lower(blank(F.col("doping_elements"))).rlike("|".join(re.escape(d.lower()) for d in dopants))) if dopants else out


def holdout(rows: DataFrame, share: float, group: str = "article_key", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of their group; all rows twice without a share, or if one side were empty."""
    share = max(0.0, min(0.95, share))
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(group)), F.lit(1_000_000))
    train, test = rows.where(at >= int(share * 1_000_000)), rows.where(at < int(share * 1_000_000))
    return (rows, rows) if not share or train.isEmpty() or test.isEmpty() else (train, test)


def perceptron(rows: DataFrame, label: str, numeric: list[str], categorical: list[str], layers: tuple[int, ...] = (96, 48), seed: int = 17, rounds: int = 100) -> PipelineModel:
    """The fallback model: a perceptron over scaled features."""
    target = StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep")
    scaled = StandardScaler(inputCol="features", outputCol="scaled")
    own = models.prepared(rows, numeric, categorical)
    prefix = Pipeline(stages=[target, *models.features(numeric, categorical), scaled]).fit(own)
    sample = prefix.transform(own).select("scaled").first()
    n = len(prefix.stages[0].labels) + 1  # and unseen ones
    net = MultilayerPerceptronClassifier(labelCol="label_index", featuresCol="scaled", layers=[len(sample["scaled"]), *layers, n], seed=seed, maxIter=rounds, predictionCol="label_prediction", probabilityCol="label_probability", rawPredictionCol="label_raw")
    return PipelineModel(stages=[*prefix.stages, net.fit(prefix.transform(own))])


def refit(rows: DataFrame, slice_rows: DataFrame, label: str, quality: str, numeric: list[str], categorical: list[str], trees: int = 20, seed: int = 17) -> PipelineModel:
    """The tabular head fitted on rows and, twice more, the slice that it is tuned to."""
    return models.train(rows.unionByName(slice_rows).unionByName(slice_rows), label, quality, numeric, categorical, trees, seed)


def system_rows(frame: DataFrame, template: DataFrame, pivoted: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """A system's own rows in the template's columns: absent numbers 0, absent texts blank, keys made by a hash of the row if it has none."""
    out = pivoted if pivoted is not None else frame
    out = out if "phase_label" in out.columns else out.withColumn("phase_label", F.coalesce(F.col("entity").cast("string") if "entity" in out.columns else F.lit(None).cast("string"), F.lit("unknown")))
    out = out if "anneal_temperature_c" in out.columns or "temperature_c" not in out.columns else out.withColumn("anneal_temperature_c", F.coalesce(F.col("temperature_c").try_cast("double"), F.lit(0.0)))
    row = F.format_string("%016x", F.xxhash64(*out.columns))
    made = {"article_key": F.concat(F.lit("system_article_"), row), "point_id": F.concat(F.lit("system_point_"), row)}
    for f in template.schema.fields:
        if f.name not in out.columns and f.name not in made:
            out = out.withColumn(f.name, F.lit(0.0) if f.name in NUMERIC or f.dataType.simpleString() in ("double", "float", "int", "bigint") else F.lit(""))
    return out.withColumns({k: c for k, c in made.items() if k not in out.columns})


def article_summary(rows: DataFrame, tokens: list[str], numeric: list[str], key: str = "article_key", most: int = 1000) -> DataFrame:
    """Per article the distinct values of some columns, sorted, up to `most` of each (more are counted, not listed), and means of others."""
    per = None
    for c in tokens:
        distinct = rows.select(key, F.col(c).alias("v")).where(F.trim(blank(F.col("v"))) != "").distinct()
        w = Window.partitionBy(key).orderBy("v")
        one = distinct.withColumn("_i", F.row_number().over(w)).groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("_i") <= most, F.col("v")))).alias(f"{c}_values"), F.count(F.lit(1)).alias(f"n_{c}"))
        per = one if per is None else per.join(one, key, "full")
    means = rows.groupBy(key).agg(*[F.avg(c).alias(f"mean_{c}") for c in numeric], F.count(F.lit(1)).alias("n_rows"))
    return means if per is None else means.join(per, key, "left")
