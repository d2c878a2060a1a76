"""Consensus of measured points per condition bin, outliers and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions.science import clamp


def bins(points: DataFrame, min_support: int = 1) -> DataFrame:
    """Per (x_bin, context): support, total weight, entropy of the entities' weights, and the winning entity with its weighted mean and population deviation of y.

    points: x, y, entity, confidence, context. Weights are confidences; the winner has the largest
    weight, ties go to the entity first by name. Two aggregations on nested keys: the first
    reduces to one row per bin and entity before anything is shuffled again.
    """
    per_entity = (
        points.withColumn("x_bin", F.bround("x", 3))
        .groupBy("x_bin", "context", "entity")
        .agg(F.sum("confidence").alias("w"), F.sum(F.col("confidence") * F.col("y")).alias("wy"), F.avg("y").alias("y_plain"), F.stddev_pop("y").alias("y_std"), F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("w")
    winner = F.min_by(F.struct("entity", "w", "wy", "y_plain", "y_std"), F.struct((-F.col("w")).alias("m"), F.col("entity").alias("e")))
    out = per_entity.groupBy("x_bin", "context").agg(
        F.sum("n").alias("support_count"), total.alias("weight"), F.when(total > 0, F.log2(total) - F.sum(F.when(F.col("w") > 0, F.col("w") * F.log2("w")).otherwise(0.0)) / total).otherwise(0.0).alias("entropy"), winner.alias("win")
    )
    return out.select(
        "x_bin", "context", "support_count", "weight", F.greatest(F.col("entropy"), F.lit(0.0)).alias("entropy"), F.col("win.entity").alias("consensus_entity"),
        F.when(F.col("win.w") > 0, F.col("win.wy") / F.col("win.w")).otherwise(F.col("win.y_plain")).alias("consensus_y"), F.col("win.y_std").alias("consensus_y_std"), (F.col("support_count") < min_support).alias("low_support"),
    )


def points(rows: DataFrame, min_support: int = 1, low_n_penalty: float = 0.15) -> DataFrame:
    """rows with their bin's consensus, model confidence and display alpha. rows: x, y, entity, confidence, context, mp_score, mp_conflict, is_outlier."""
    b = bins(rows, min_support).withColumnRenamed("context", "_context")
    joined = rows.withColumn("_x", F.bround("x", 3)).join(b, (F.col("_x") == F.col("x_bin")) & (F.col("context") == F.col("_context"))).drop("_x", "_context")
    penalty = F.when(F.col("low_support"), 1 - low_n_penalty).otherwise(1.0)
    base = F.col("confidence") / (1 + F.col("entropy")) * penalty
    alpha = F.when(F.col("is_outlier"), 0.15).when(F.col("entity") == F.col("consensus_entity"), 0.9).otherwise(0.35)
    return joined.withColumn("model_confidence", clamp(base * (0.90 + 0.20 * F.col("mp_score")))).withColumn("display_alpha", F.when(F.col("mp_conflict") & ~F.col("is_outlier"), F.least(alpha, F.lit(0.20))).otherwise(alpha))


#: Rank error of the bounds between which a median is looked for exactly.
ACCURACY = 20_000


def medians(rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """keys, n and the exact median of value per group, none of whose values are ever held together.

    Approximate quantiles bound the median by a few parts in ACCURACY of the group; the values
    between them are counted by value, and those counts alone are put in order.
    """
    slack = 2.0 / ACCURACY
    bounds = rows.groupBy(*keys).agg(F.percentile_approx(value, F.array(F.lit(0.5 - slack), F.lit(0.5 + slack)), F.lit(ACCURACY)).alias("_b"), F.count(value).alias("_n"))
    named = bounds.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"), "_n")
    near = rows.select(*keys, F.col(value).alias("_v")).join(named, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    place = F.when(F.col("_v") < F.col("_lo"), F.lit(None)).otherwise(F.col("_v"))
    counts = near.where("_v <= _hi").groupBy(*[f"_k{i}" for i in range(len(keys))], "_n", place.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy(F.asc_nulls_first("_v"))
    upto = counts.withColumn("_end", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda rank: F.min(F.when(F.col("_v").isNotNull() & (F.col("_end") > rank), F.col("_v")))
    out = upto.groupBy(*[f"_k{i}" for i in range(len(keys))], "_n").agg(((at(F.floor((F.col("_n") - 1) / 2)) + at(F.ceil((F.col("_n") - 1) / 2))) / 2).alias("median"))
    return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_n").alias("n"), "median")


def mad_outliers(rows: DataFrame, y: str, by: list[str], threshold: float = 3.5, least: int = 5) -> DataFrame:
    """rows with is_outlier: robust z-score 0.6745·|y - median| / MAD above threshold, in groups of at least `least` rows."""
    keyed = lambda t, name, *more: t.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("median").alias(name), *more)
    same = lambda t: [F.col(c) == t[f"_{c}"] for c in by]
    middle = keyed(medians(rows, y, by), "_median", F.col("n").alias("_n"))
    near = rows.join(middle, same(middle)).drop(*[f"_{c}" for c in by])
    mads = keyed(medians(near.select(*by, F.abs(F.col(y) - F.col("_median")).alias("_off")), "_off", by), "_mad")
    z = 0.6745 * F.abs(F.col(y) - F.col("_median")) / F.col("_mad")
    return near.join(mads, same(mads)).withColumn("is_outlier", (F.col("_n") >= least) & (F.col("_mad") > 0) & (z > threshold)).drop("_median", "_n", "_mad", *[f"_{c}" for c in by])


def summary(rows: DataFrame) -> DataFrame:
    """One row over consensus points."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_points"), F.countDistinct("entity").alias("n_entities"), F.count_if("is_outlier").alias("n_outliers"), F.avg("entropy").alias("mean_entropy"), F.avg("model_confidence").alias("mean_model_confidence"),
        F.avg(F.col("mp_conflict").cast("double")).alias("conflict_rate"), F.count_if(F.col("entity") == F.col("consensus_entity")).alias("n_agreeing"),
    )


def curve(rows: DataFrame, x: str, confidence: str, tie: list[Column]) -> DataFrame:
    """The most confident row of each x."""
    w = Window.partitionBy(x).orderBy(F.desc(confidence), *tie)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
